"""Person records: contact blocks, summaries, change texts, data-quality exceptions, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.rules import flag
from fathomline.functions.text import map_codes, message, strip_markup
from fathomline.operators.aggs import concat_ordered, profile_nulls
from fathomline.operators.joins import effective_at, value_changes
from fathomline.operators.keys import exists_flag, latest_per_key
from fathomline.operators.ordered import scan


def draft_contacts(requests: DataFrame, phones: DataFrame, emails: DataFrame, at: Column) -> DataFrame:
    """Latest open request per person with the preferred phone and e-mail in force at a date.

    requests: person_id, request_id, ts, complete; phones and emails: person_id, value, preferred, start, end
    """
    newest = [F.col("ts").desc(), F.col("request_id").desc()]
    last = latest_per_key(requests.filter("complete = 0"), ["person_id"], newest)

    def best(contacts: DataFrame, name: str) -> DataFrame:
        order = [F.col("preferred").desc(), F.col("start").desc_nulls_last(), F.col("value").asc()]
        return latest_per_key(effective_at(contacts, "start", "end", at), ["person_id"], order).select("person_id", F.col("value").alias(name))

    return last.join(best(phones, "phone"), "person_id", "left").join(best(emails, "email"), "person_id", "left")


def contact_blocks(blocks: DataFrame) -> DataFrame:
    """Rows of a person numbered within their kind in order of start, the last one flagged, with a text.

    blocks: person_id, kind, block_id, start, line_1, line_2
    """
    counted, ahead = {"block_no": ("sum", F.lit(1).cast("long"))}, {"_next": F.col("block_id")}
    out = scan(blocks, ["person_id", "kind"], ["start", "block_id"], measures=counted, after=ahead)
    text = message([("", F.col("line_1")), ("", F.col("line_2"))], ", ")
    return out.withColumns({"last_of_kind": flag(F.col("_next").isNull()), "block_text": text}).drop("_next")


def latest_sections(people: DataFrame, key: str, sections: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """People with the latest row of each section.

    sections: name -> (rows, ascending order columns, payload columns). Each section is a grouped maximum, combined
    before its shuffle; all are grouped by the key they are joined on, so the joins shuffle nothing again.
    """
    out = people
    for name, (rows, order, payload) in sections.items():
        last = rows.groupBy(key).agg(F.max(F.struct(*order, F.struct(*payload).alias("_payload"))).alias("_last"))
        out = out.join(last.select(key, *[F.col(f"_last._payload.{c}").alias(f"{name}_{c}") for c in payload]), key, "left")
    return out


@dataclass(frozen=True)
class Rule:
    """A data-quality rule: its name, when it applies, and the message it writes."""

    name: str
    applies: Column
    parts: Sequence[tuple[str, Column | str]]


def two_forms(rule: Rule, deceased: Column) -> list[Rule]:
    """The rule for living and for deceased persons under two names."""
    return [
        Rule(f"{rule.name} - living", rule.applies & ~deceased, rule.parts),
        Rule(f"{rule.name} - deceased", rule.applies & deceased, rule.parts),
    ]


def not_published(rules: Sequence[Rule], draft: Column) -> list[Rule]:
    """Rules that hold only for records that are still drafts, named so."""
    return [Rule(f"Not published - {r.name}", draft & r.applies, r.parts) for r in rules]


def exception_report(base: DataFrame, keys: Sequence[str], rules: Sequence[Rule], contact: Sequence[str] = ()) -> DataFrame:
    """One row per broken rule, with the contact columns of the record. All rules are tested in one pass over the base;
    nothing is scanned again per rule. Rule names must differ."""
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise ValueError("two rules have one name")
    hits = [F.when(r.applies, F.struct(F.lit(r.name).alias("exception"), message(r.parts).alias("detail"))) for r in rules]
    return base.select(*keys, *contact, F.inline(F.array_compact(F.array(*hits))))


def publication_state(draft: Column, deleted: Column, deceased: Column, consent: Column) -> Column:
    """Why a record is not published: the first reason that holds."""
    return (
        F.when(deleted, "Deleted").when(deceased, "Deceased before publication").when(~consent, "No consent").when(draft, "Draft").otherwise("Published")
    )


def change_texts(current: DataFrame, historic: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Changes of a record as one text, attributes in order. Both sides have one row per key."""
    changes = value_changes(current, historic, [key], columns)
    text = changes.withColumn("text", F.concat("attribute", F.lit(": "), "historic_value", F.lit(" -> "), "current_value"))
    return concat_ordered(text, [key], "text", ["attribute"], "; ", "changes")


def feed_profile(feed: DataFrame, t: str, after: Column) -> DataFrame:
    """NULL profile of the rows after a date."""
    return profile_nulls(feed.filter(F.col(t) > after))


def newest_sample(feed: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The n newest rows: a top-n report."""
    return feed.orderBy(*order).limit(n)


def decoded_record(
    people: DataFrame,
    codes: Mapping[str, tuple[Mapping[object, str], str]],
    lookups: Mapping[str, tuple[DataFrame, str, str]],
    created: str,
    ends: Sequence[str],
    texts: DataFrame,
    flags: Mapping[str, DataFrame],
    key: str,
) -> DataFrame:
    """A record with everything decoded.

    codes: column -> (labels, default); lookups: new column -> (reference unique on its key, key column, value column);
    ends: dates the days on the system are counted to; texts: key, html; flags: new column -> rows that make it 1
    """
    out = people.withColumns({f"{c}_text": map_codes(c, labels, default) for c, (labels, default) in codes.items()})
    for name, (ref, on, value) in lookups.items():
        out = out.join(ref.select(on, F.col(value).alias(name)), on, "left")
    out = out.withColumns({f"days_to_{e}": F.datediff(e, created) for e in ends})
    plain = texts.select(key, strip_markup("html").alias("plain_text"))
    out = out.join(plain, key, "left")
    for name, rows in flags.items():
        out = exists_flag(out, rows, [key], name)
    return out


def text_blocks(blocks: Mapping[str, DataFrame], key: str) -> DataFrame:
    """All text blocks of a record side by side: key, and per name `<name>_html` as stored and `<name>` without markup.

    blocks: name -> (key, html). All kinds go through one union and one grouping, so the record is joined once however many blocks it
    has, and markup is removed after the rows are joined together. Of several rows of a kind and key the largest text counts; a NULL key is
    left out, and a key without any block has no row.
    """
    long = reduce(lambda a, b: a.unionByName(b), [rows.select(key, F.lit(name).alias("kind"), "html") for name, rows in blocks.items()])
    wide = long.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(F.when(F.col("kind") == name, F.col("html"))).alias(f"{name}_html") for name in blocks])
    return wide.withColumns({name: strip_markup(f"{name}_html") for name in blocks})


def as_markup(parts: Sequence[tuple[str, Column | str]], missing: str = "(N/A)") -> Column:
    """Labels and values as one definition list, a default for missing values; the marks of markup are spelt out in values."""
    out = [F.lit("<dl>")]
    for label, value in parts:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        for mark, spelt in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(mark), F.lit(spelt))
        out += [F.lit(f"<dt>{label}</dt><dd>"), F.coalesce(text, F.lit(missing)), F.lit("</dd>")]
    return F.concat(*out, F.lit("</dl>"))


def practice_details(people: DataFrame, staff: DataFrame, practices: DataFrame) -> DataFrame:
    """People (staff_id, practice_id) with their practitioner and practice, and both as one text block.

    staff: staff_id, staff_title, forename, surname, staff_code; practices: practice_id, practice, practice_code, practice_email, practice_phone,
    practice_address, practice_postcode; both unique on their id. A name is what is known of it, NULL where nothing is.
    """
    name = F.nullif(F.concat_ws(" ", F.nullif(F.trim("forename"), F.lit("")), F.nullif(F.trim("surname"), F.lit(""))), F.lit(""))
    who = staff.select("staff_id", name.alias("practitioner"), "staff_title", "staff_code")
    out = people.join(who, "staff_id", "left").join(practices, "practice_id", "left")
    listed = [
        ("Practitioner", "practitioner"),
        ("Title", "staff_title"),
        ("Staff code", "staff_code"),
        ("Practice", "practice"),
        ("Practice code", "practice_code"),
        ("Postcode", "practice_postcode"),
        ("Phone", "practice_phone"),
    ]
    html = as_markup(listed)
    return out.withColumns({"practice_html": html, "practice_text": strip_markup(html)})


def full_record(decoded: DataFrame, staff: DataFrame, practices: DataFrame, blocks: Mapping[str, DataFrame], key: str, unknown: Mapping[str, str] | None = None) -> DataFrame:
    """A decoded record (see `decoded_record`) with its practice and all its text blocks.

    unknown: column -> the text that means that nothing is recorded, which becomes NULL.
    """
    known = decoded.withColumns({c: F.nullif(F.rtrim(c), F.lit(label)) for c, label in (unknown or {}).items()})
    return practice_details(known, staff, practices).join(text_blocks(blocks, key), key, "left")
