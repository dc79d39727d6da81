"""Secret scans by multipart credential linking (operator 13), in DataFrame functions only.

Base findings are matches of three fixed patterns that are long enough. What falls short of
that is a weak candidate: a short assigned value, a short access id, a short run of hexadecimal
digits. A credential has three parts, an identifier (access id, user, account, client), a secret
and an endpoint (URL, host); a weak candidate is reported only where parts that complement it
start within `SCOPE` code points of its own start: an identifier and an endpoint for a
weak secret, a secret and an endpoint for a weak access id.

Places of matches come from the text cut at them: a match starts after all pieces and matches
before it, a running sum per document and pattern. The interval join works on scopes of
`SCOPE` code points: parts are reduced to the first and the last start per document, scope
and role before they are joined, and a candidate meets the three scopes around it. That is exact
(the last part of the scope before, any part of its own, the first of the scope after), and no
pairs of parts are made, however many stand together.

Defined results: a null text is empty and has no findings; repeated rows and null ids are rows
like any other; texts are scanned whole, places count code points. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetlake.session import staged

SCOPE = 300


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SET_TO = r"""["']?\x20*[:=]\x20*["']?"""
_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_OWNERS = "|".join(map(_either_case, ("username", "user", "login", "account", "client_?id")))
_PLACES = "|".join(map(_either_case, ("endpoint", "hostname", "host", "server")))
#: Shortest value, or match, of a base finding and of a weak candidate.
ASSIGN, ACCESS, HEX = (12, 6), (18, 9), (16, 12)
#: Hexadecimal runs and access ids that are too short fail wholly, so their length is in the pattern.
PATTERNS = {
    "assign": rf"({_NAMES}){_SET_TO}([A-Za-z0-9+/_.=-]+)",
    "access": rf"AKIA[A-Z0-9]{{{ACCESS[1] - 4},}}",
    "hex": rf"[0-9a-f]{{{HEX[1]},}}",
}
#: Parts that only complement others.
PARTS = {
    "identifier": rf"({_OWNERS}){_SET_TO}([A-Za-z0-9+/_.@-]+)",
    "endpoint": rf"[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D\"'<>]+|({_PLACES}){_SET_TO}[A-Za-z0-9][A-Za-z0-9.:-]+",
}
BASE = ("assign", "access", "hex")
#: Kinds as listed: base findings, then those linking adds.
KINDS = (*BASE, "weak_assign", "weak_access", "weak_hex")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _hits(text: Column, pattern: str, valued: bool) -> Column:
    """Per match: code points since the last one, its length, and that of its value."""
    found = _matches(text, pattern)
    pieces = F.transform(F.split(text, pattern, -1), F.length)

    def hit(gap: Column, match: Column) -> Column:
        value = F.regexp_extract(match, pattern, 2) if valued else match
        return F.struct(gap.alias("gap"), F.length(match).alias("len"), F.length(value).alias("value"))

    hits = F.zip_with(F.slice(pieces, 1, F.size(found)), found, hit)
    return F.when(text.rlike(pattern), hits)


def _is_weak(hits: str, sizes: tuple[int, int]) -> Column:
    found = F.exists(hits, lambda h: h["value"].between(sizes[1], sizes[0] - 1))
    return F.coalesce(found, F.lit(False))


def _scanned(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, hits of each pattern), written, so that a row's number stays."""
    full = F.coalesce(F.col(text), F.lit(""))
    row = F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col(doc_id).alias("doc_id"), full.alias("text"))
    hits = [_hits(F.col("text"), p, k == "assign").alias(k) for k, p in PATTERNS.items()]
    rows = rows.select("*", *hits)
    weak = _is_weak("assign", ASSIGN) | _is_weak("access", ACCESS) | _is_weak("hex", HEX)
    rows = rows.withColumn("weak", weak)
    others = [F.when(F.col("weak"), _hits(F.col("text"), p, False)).alias(k) for k, p in PARTS.items()]
    return staged(rows.select("row", "doc_id", *PATTERNS, *others), "secrets")


def _placed(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end) of base findings, weak candidates and other parts."""
    kinds = F.array(
        *[F.struct(F.lit(k).alias("pattern"), F.col(k).alias("hits")) for k in (*PATTERNS, *PARTS)]
    )
    hits = scanned.select("row", F.explode(kinds).alias("k"))
    hits = hits.select("row", "k.pattern", F.posexplode("k.hits").alias("turn", "hit"))
    so_far = Window.partitionBy("row", "pattern").orderBy("turn")
    end = F.sum(F.col("hit.gap") + F.col("hit.len")).over(so_far).cast("int")
    rows = hits.select("row", "pattern", end.alias("end"), "hit.len", "hit.value")

    def kind(name: str, sizes: tuple[int, int]) -> Column:
        return F.when(F.col("value") >= sizes[0], name).when(F.col("value") >= sizes[1], f"weak_{name}")

    named = F.col("pattern")
    for name, sizes in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        named = F.when(F.col("pattern") == name, kind(name, sizes)).otherwise(named)
    rows = rows.select("row", named.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end")
    return rows.filter("kind IS NOT NULL")


def _linked(parts: DataFrame) -> DataFrame:
    """Weak candidates of (row, kind, start, end) with complementary parts in scope."""
    is_one = {
        "identifier": F.col("kind").isin("access", "weak_access", "identifier"),
        "secret": F.col("kind").isin("assign", "hex", "weak_assign", "weak_hex"),
        "endpoint": F.col("kind") == "endpoint",
    }
    scope = F.floor(F.col("start") / SCOPE)
    ends = [
        f(F.when(one, F.col("start"))).alias(f"{role}_{name}")
        for role, one in is_one.items()
        for f, name in ((F.min, "first"), (F.max, "last"))
    ]
    reduced = parts.groupBy("row", scope.alias("scope")).agg(*ends)
    weak = parts.filter(F.col("kind").startswith("weak_"))
    around = F.explode(F.array(scope - 1, scope, scope + 1)).alias("scope")
    met = weak.select("row", "kind", "start", "end", around).join(reduced, ["row", "scope"])

    def near(role: str) -> Column:
        apart = lambda c: F.abs(F.col(c) - F.col("start")) <= SCOPE
        return F.coalesce(F.bool_or(apart(f"{role}_first") | apart(f"{role}_last")), F.lit(False))

    found = met.groupBy("row", "kind", "start", "end").agg(*[near(r).alias(r) for r in is_one])
    lacks = F.when(F.col("kind") == "weak_access", F.col("secret")).otherwise(F.col("identifier"))
    return found.filter(lacks & F.col("endpoint")).select("row", "kind", "start", "end")


def spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end) of all that is reported."""
    parts = staged(_placed(scanned), "secret-parts")
    return parts.filter(F.col("kind").isin(*BASE)).unionByName(_linked(parts))


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = _scanned(docs, doc_id, text)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    per_row = spans(rows).groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.sort_array(F.collect_list(span)).alias("found"),
    )

    def joined(found: Column) -> Column:
        said = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.coalesce(F.array_join(said, ","), F.lit(""))

    base = F.filter("found", lambda s: s["rank"] <= len(BASE))
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _hits_sql(kind: str, pattern: str) -> str:
    return f"""
  SELECT r, '{kind}' AS pattern, unnest(range(1, 1 + len(m))) AS k,
    unnest(m) AS match, unnest(p[1:len(m)]) AS piece
  FROM (SELECT r, regexp_extract_all(text, {_quoted(pattern)}) AS m,
    string_split_regex(text, {_quoted(pattern)}) AS p FROM d)"""


#: The result as DuckDB states it; parts are joined one by one.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
h AS ({" UNION ALL ".join(_hits_sql(k, p) for k, p in (PATTERNS | PARTS).items())}),
e AS (
  SELECT r, pattern, length(match) AS size,
    CASE WHEN pattern = 'assign' THEN length(regexp_extract(match, {_quoted(PATTERNS["assign"])}, 2))
      ELSE length(match) END AS value,
    sum(length(piece) + length(match)) OVER (PARTITION BY r, pattern ORDER BY k) AS stop
  FROM h),
p AS (
  SELECT r, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, CASE
    WHEN pattern IN ('identifier', 'endpoint') THEN pattern
    WHEN value >= CASE pattern WHEN 'assign' THEN {ASSIGN[0]} WHEN 'access' THEN {ACCESS[0]}
      ELSE {HEX[0]} END THEN pattern
    WHEN pattern <> 'assign' OR value >= {ASSIGN[1]} THEN 'weak_' || pattern END AS kind
  FROM e),
s AS (
  SELECT * FROM p WHERE kind IN ('assign', 'access', 'hex')
  UNION ALL
  SELECT * FROM p AS w WHERE kind LIKE 'weak%'
    AND EXISTS (SELECT 1 FROM p AS o WHERE o.r = w.r AND abs(o.start - w.start) <= {SCOPE}
      AND o.kind = 'endpoint')
    AND EXISTS (SELECT 1 FROM p AS o WHERE o.r = w.r AND abs(o.start - w.start) <= {SCOPE}
      AND CASE WHEN w.kind = 'weak_access'
        THEN o.kind IN ('assign', 'hex', 'weak_assign', 'weak_hex')
        ELSE o.kind IN ('access', 'weak_access', 'identifier') END)),
n AS (
  SELECT *, list_position(['assign', 'access', 'hex', 'weak_assign', 'weak_access', 'weak_hex'],
    kind) AS rank, kind || ':' || start || ':' || stop AS said FROM s),
g AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (rank <= 3), '') AS base,
    string_agg(said, ',' ORDER BY start, rank) AS spans
  FROM n GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""
