"""Secret scans with corpus-wide ownership.

Every text is searched for candidates, and each candidate's value is hashed. Hashes are then counted over the whole corpus by
distinct owners and repositories: a value that many owners carry, or that one owner has copied into many repositories, is an
example; any other value of one owner that looks random is a live credential of that owner. Values themselves never leave
the task that found them; only hashes do.

Defined edge cases: a null or empty text has no candidates; a null owner or repository counts as one owner or repository
of its own (the empty name); repeated rows are rows of their own (same owner and repository, so they don't make a value an
example); a text of any length is searched whole; an empty table gives no rows; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.session import Stages

# The kinds in the order in which spans at one place are listed, and their patterns. The first three are base kinds.
KINDS = ("assign", "access", "hex", "key", "bare")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}")
PLACEHOLDER = re.compile(r"example|sample|changeme|your|dummy|xxxx|1234567|00000000|aaaaaaaa", re.I)

COUNTED = ("owners", "repositories", "occurrences")

SCHEMA = (
    "row long, doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "found array<struct<kind:int,start:int,end:int,hash:string,random:boolean>>"
)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind number, start, end, value) of one text, by start and kind; places are code points, the end is exclusive."""
    base = [(0, m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(1, m.start(), m.end(), m.group()) for m in ACCESS.finditer(text)]
    base += [(2, m.start(), m.end(), m.group()) for m in HEX.finditer(text)]
    more = [(3, m.start(), m.end(), m.group()) for m in KEY.finditer(text)]
    for m in BARE.finditer(text):
        value = m.group()
        mixed = re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)
        if mixed and not any(s < m.end() and m.start() < e for _, s, e, _ in base):
            more.append((4, m.start(), m.end(), value))
    return sorted(base + more, key=lambda c: (c[1], c[0]))


def looks_random(value: str) -> bool:
    """Letters and digits mixed, 16 characters or more, and no mark of a placeholder."""
    return len(value) >= 16 and bool(re.search("[0-9]", value)) and bool(re.search("[A-Za-z]", value)) and not PLACEHOLDER.search(value)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string()), ("random", pa.bool_())])
    )
    for batch in batches:
        counts: tuple[list, list, list] = ([], [], [])
        digests, found = [], []
        for text in batch.column("text"):
            got = candidates(text.as_py() or "")
            for k in range(3):
                counts[k].append(sum(c[0] == k for c in got))
            digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in got if k < 3).encode()).hexdigest())
            found.append(
                [
                    {"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "random": looks_random(v)}
                    for k, s, e, v in got
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("row", "doc_id", "owner", "repository")]
            + [pa.array(c, pa.int64()) for c in counts]
            + [pa.array(digests, pa.string()), pa.array(found, kind)],
            names=["row", "doc_id", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "found"],
        )


def scan(docs: DataFrame, owner: Column, repository: Column, stages: Stages) -> DataFrame:
    """One row per document with its candidates, written to the shared folder."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.col("text").cast("string").alias("text"),
    )
    return stages.write(rows.mapInArrow(_scan, SCHEMA), "secret-scan")


def ownership(scanned: DataFrame) -> DataFrame:
    """Per hash: distinct owners, distinct repositories, occurrences. Occurrences of a hash are summed before each shuffle,
    so that a value which stands in a third of all texts sends one row per task, owner and repository."""
    each = scanned.select("owner", "repository", F.explode("found").alias("c"))
    held = each.groupBy(F.col("c.hash").alias("hash"), "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    return held.groupBy("hash").agg(
        F.countDistinct("owner").alias("owners"), F.countDistinct("repository").alias("repositories"), F.sum("n").alias("occurrences")
    )


def judge(scanned: DataFrame, owned: DataFrame, example_owners: int = 3, example_repositories: int = 4) -> DataFrame:
    """One row per candidate with its verdict: `example` if `example_owners` owners or more, or `example_repositories`
    repositories or more, carry the value, `live` if one owner does and it looks random, else `unsure`. The
    value's owners, repositories and occurrences stand beside it."""
    each = scanned.select("row", "doc_id", F.explode("found").alias("c")).select("row", "doc_id", "c.*")
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    verdict = (
        F.when(copied, "example").when((F.col("owners") == 1) & F.col("random"), "live").otherwise("unsure")
    )
    return each.join(owned, "hash").withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, owner: Column, repository: Column, example_owners: int = 3, example_repositories: int = 4) -> DataFrame:
    """doc_id, counts and digest of the base kinds, all spans, and candidates by verdict; one row per document.

    Spans are those of the base kinds, of private-key headers, and of bare random strings that only one owner has. n_owners,
    n_repositories and n_occurrences add up what `judge` says of each span's value."""
    stages = Stages(docs.sparkSession)
    scanned = scan(docs, owner, repository, stages)
    owned = stages.write(ownership(scanned), "secret-owners")
    judged = judge(scanned, owned, example_owners, example_repositories)
    kept = judged.filter((F.col("kind") != KINDS.index("bare")) | (F.col("verdict") == "live"))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.sort_array(F.collect_list(F.struct("start", "kind", "end")))
    per_row = kept.groupBy("row").agg(
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",").alias("spans"),
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "example").alias("n_example"),
        *[F.sum(c).alias(f"n_{c}") for c in COUNTED],
    )
    return scanned.join(per_row, "row", "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        *[F.coalesce(f"n_{c}", F.lit(0)).cast("long").alias(f"n_{c}") for c in COUNTED],
    )


#: The same result in DuckDB: places come from the lengths of what stands between the matches.
SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
                     coalesce(source, '') || '/' || coalesce(lang, '') AS repository FROM documents),
patterns(kind, name, pattern, at_least) AS (VALUES
  (0, 'assign', '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 0),
  (1, 'access', 'AKIA[A-Z0-9]+', 20), (2, 'hex', '[0-9a-f]+', 24), (3, 'key', '-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----', 0),
  (4, 'bare', '[A-Za-z0-9+/_=-]{32,}', 0)),
split AS (SELECT r, owner, repository, kind, name, at_least, regexp_extract_all(text, pattern) AS found,
                 string_split_regex(text, pattern) AS rest FROM rows, patterns),
hits AS (SELECT r, owner, repository, kind, name, at_least, unnest(found) AS v, unnest(range(1, len(found) + 1)) AS i, found, rest FROM split),
placed AS (SELECT r, owner, repository, kind, name, at_least, v,
  list_sum([length(x) FOR x IN rest[:i]])::BIGINT + coalesce(list_sum([length(x) FOR x IN found[:i - 1]]), 0)::BIGINT AS s
  FROM hits),
valued AS (SELECT *, s + length(v) AS e, CASE WHEN kind = 0 THEN
  regexp_extract(v, '(?i)^(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) ELSE v END AS val FROM placed),
long AS (SELECT * FROM valued WHERE length(v) >= at_least AND (kind <> 0 OR length(val) >= 6)),
base AS (SELECT * FROM long WHERE kind < 3),
cand AS (SELECT * FROM long l WHERE kind <> 4 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = l.r AND b.s < l.e AND l.s < b.e))),
owned AS (SELECT val, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories, count(*) AS occurrences FROM cand GROUP BY val),
judged AS (SELECT c.*, owners, repositories, occurrences, CASE WHEN owners >= 3 OR repositories >= 4 THEN 'example' WHEN owners = 1 AND length(c.val) >= 16 AND regexp_matches(c.val, '[0-9]')
  AND regexp_matches(c.val, '[A-Za-z]') AND NOT regexp_matches(c.val, '(?i)example|sample|changeme|your|dummy|xxxx|1234567|00000000|aaaaaaaa')
  THEN 'live' ELSE 'unsure' END AS verdict FROM cand c JOIN owned USING (val)),
kept AS (SELECT * FROM judged WHERE kind <> 4 OR verdict = 'live'),
per AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
  count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example,
  sum(owners)::BIGINT AS n_owners, sum(repositories)::BIGINT AS n_repositories, sum(occurrences)::BIGINT AS n_occurrences FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(n_owners, 0) AS n_owners, coalesce(n_repositories, 0) AS n_repositories, coalesce(n_occurrences, 0) AS n_occurrences
FROM rows LEFT JOIN per USING (r)
"""
