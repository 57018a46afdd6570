"""Secret scans with linking of credential parts, in DataFrame functions only.

Strong findings (BASE) are reported wherever they stand. Weak candidates are parts of a credential
that mean little alone: a 40-character key, an assigned value of under 6 characters, a user or client
name, an endpoint. They are reported only if their complement stands within SCOPE characters:
a weak secret needs an identifier, a weak identifier a secret, an endpoint both.

Spans are found by splitting a text at the matches: the lengths of gaps and matches, summed in order,
give code point positions. The interval join cuts positions into bins of SCOPE; what a bin holds of a role
is pre-aggregated to its least start and greatest end, which decide exactly whether a candidate's scope
touches one, so pairs are never formed.

Defined cases: a null text is empty and has no findings; every row gets a row. Rows of equal id and
text are scanned once for the joins and all reported. Empty tables give no rows. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from platterwatch.sources.storage import stage

SCOPE = 200

# The three base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
NAME = r"""(?i:user(?:name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+"""
ENDPOINT = r"""https?://[^\s"'<>]+|[a-z0-9.-]+\.amazonaws\.com"""

# number, kind, pattern, text that every match contains; kinds are ordered by number
PATTERNS = (
    (0, "assign", ASSIGN, None),
    (1, "access", ACCESS, "AKIA"),
    (2, "hex", HEX, None),
    (3, "key", KEY, None),
    (5, "name", NAME, None),
    (6, "endpoint", ENDPOINT, "."),
)
BASE = 3  # kinds of a smaller number are strong
SHORT = 4  # an assigned value that the base drops
LEAST_VALUE = 6
NAMES = {number: kind for number, kind, *_ in PATTERNS} | {SHORT: "short"}
ROLES = {0: "secret", 1: "name", 2: "secret", 3: "secret", 4: "secret", 5: "name", 6: "endpoint"}
NEEDS = {"secret": ["name"], "name": ["secret"], "endpoint": ["name", "secret"]}


def matches(text: Column) -> Column:
    """The matches of every pattern, as a struct of arrays."""
    out = []
    for number, _, pattern, needed in PATTERNS:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if needed:
            found = F.when(F.contains(text, F.lit(needed)), found)
        out.append(found.alias(f"found_{number}"))
    return F.struct(*out)


def between(text: Column) -> Column:
    """The gaps between the matches of every pattern that has any, and the assigned values."""
    gaps = [
        F.when(F.size(f"found_{number}") > 0, F.split(text, pattern, -1)).alias(f"gaps_{number}")
        for number, _, pattern, _ in PATTERNS
    ]
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.struct(*gaps, F.when(F.size("found_0") > 0, values).alias("value"))


def lengths(number: int) -> Column:
    """For each match of a pattern: length of the gap before it, its length, its kind's number."""
    found = F.col(f"found_{number}")
    zipped = [found.alias("found"), F.slice(f"gaps_{number}", 1, F.size(found)).alias("gap")]
    kind = lambda x: F.lit(number)
    if number == 0:
        zipped.append(F.col("value").alias("value"))
        kind = lambda x: F.when(F.length(x["value"]) >= LEAST_VALUE, 0).otherwise(SHORT)
    return F.transform(
        F.arrays_zip(*zipped),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"), F.length(x["found"]).alias("size"), kind(x).alias("kind")
        ),
    )


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: id, mark of every document; spans: id, mark, kind, start, end, once per document)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # One-row generators keep the projections apart: put into one another they would scan the text again for
    # every match that a lambda looks at.
    matched = docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64("doc_id", "text").alias("mark"),
        text.alias("text"),
        F.inline(F.array(matches(text))),
    )
    matched = matched.select("*", F.inline(F.array(between(F.col("text")))))
    scanned = matched.select(
        "id",
        "mark",
        F.array_compact(
            F.array(*[
                F.when(
                    F.size(f"found_{n}") > 0, F.struct(F.lit(n).alias("scan"), lengths(n).alias("found"))
                )
                for n, *_ in PATTERNS
            ])
        ).alias("scans"),
    )
    rows = stage(scanned, "scans")
    each = (
        rows.where(F.size("scans") > 0)
        .select("id", "mark", F.explode("scans").alias("s"))
        .select("id", "mark", "s.scan", F.posexplode("s.found").alias("place", "m"))
        .distinct()
    )
    order = W.partitionBy("id", "mark", "scan").orderBy("place")
    ends = F.sum(F.col("m.gap") + F.col("m.size")).over(order)
    found = each.select(
        "id", "mark", F.col("m.kind").alias("kind"),
        (ends - F.col("m.size")).alias("start"), ends.alias("end"),
    )
    return rows.select("id", "mark"), stage(found, "spans")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans of which every needed part stands within the scope."""
    role = F.lit(None)
    for number, name in ROLES.items():
        role = F.when(F.col("kind") == number, name).otherwise(role)
    parts = found.withColumn("role", role)
    held = (
        parts.where("role <> 'endpoint'")
        .withColumn("bin", F.explode(bins("start", "end", scope, 0)))
        .groupBy("id", "mark", "role", "bin")
        .agg(F.min("start").alias("least"), F.max("end").alias("most"))
    )
    needs = F.lit(None).cast("array<string>")
    for name, needed in NEEDS.items():
        needs = F.when(F.col("role") == name, F.array(*map(F.lit, needed))).otherwise(needs)
    weak = parts.where(F.col("kind") >= BASE).withColumn("needed", F.size(needs))
    asked = weak.select(
        F.col("id").alias("of"), F.col("mark").alias("of_mark"), "kind", "start", "end", "needed",
        F.explode(needs).alias("wants"),
    ).withColumn("at", F.explode(bins("start", "end", scope, scope)))
    near = (
        (F.col("id").eqNullSafe(F.col("of")))
        & (F.col("mark") == F.col("of_mark"))
        & (F.col("role") == F.col("wants"))
        & (F.col("bin") == F.col("at"))
        & (F.col("least") < F.col("end") + scope)
        & (F.col("most") > F.col("start") - scope)
    )
    return (
        asked.join(held, near, "left_semi")
        .select("of", "of_mark", "kind", "start", "end", "needed", "wants")
        .distinct()
        .groupBy("of", "of_mark", "kind", "start", "end", "needed")
        .count()
        .where("count = needed")
        .select(F.col("of").alias("id"), F.col("of_mark").alias("mark"), "kind", "start", "end")
    )


def bins(start: str, end: str, scope: int, margin: int) -> Column:
    low = F.floor((F.col(start) - margin) / scope)
    return F.sequence(low, F.floor((F.col(end) - 1 + margin) / scope))


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    rows, found = spans(docs)
    base = found.where(F.col("kind") < BASE)
    listed = (
        base.unionByName(linked(found, scope))
        .groupBy(F.col("id").alias("of"), F.col("mark").alias("of_mark"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    )
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))
    every = F.coalesce("all", F.array().cast(listed.schema["all"].dataType))
    strong = F.filter(every, lambda x: x["kind"] < BASE)
    count = lambda n: F.size(F.filter(every, lambda x: x["kind"] == n)).cast("bigint")
    return rows.join(listed, same, "left").select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(strong), 256).alias("base_sha256"),
        written(every).alias("spans"),
    )


def written(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.create_map(*[F.lit(x) for pair in sorted(NAMES.items()) for x in pair])
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )
