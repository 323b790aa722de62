"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each source has a target share of the output; its repetition rate is that share of the output's
size over the source's size.  Every document gets a Poisson number of copies with this mean, from
the inverse distribution function at a number in [0, 1) that is a hash of the seed, the id and the
text.  So the draw needs no shared state, is the same on every run, and a lost task repeats it exactly.
Rates above ``DRAW_RATE`` are split into several draws, as sums of Poisson numbers are Poisson.
The copies are put into a global random order by sorting on a hash of seed, id, text and copy; rows
that share an id draw, and are sorted, by their own texts.

Defined results: null is a source like any other.  A null id is hashed as the text ``null``, a null
text as an empty one.  Rows with the same id and text get the same number of copies each.  Sources
without a weight get none of the output.  A text of any length is hashed whole.  An empty table, or
one without weights, has no rows.  Extra columns are kept, whatever their names, but for one named
``copy``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import unused

#: Largest mean of one draw, terms of its distribution, hex digits of a hash, sources to broadcast.
DRAW_RATE, TERMS, DIGITS, BROADCAST_SOURCES = 8.0, 64, 12, 10_000


def tempered_weights(docs: DataFrame, power: float = 0.5, source_col: str = "source") -> DataFrame:
    """(source, weight): sizes raised to ``power``, which lifts small sources and dampens large ones."""
    sizes = docs.groupBy(docs[source_col].alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, size: float = 1.0, source_col: str = "source") -> DataFrame:
    """(mix_source, rate): mean copies of a source's documents; ``size`` is the output's size in inputs."""
    counts = docs.groupBy(docs[source_col].alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.join(weights, F.col("mix_source").eqNullSafe(weights["source"])).where("weight > 0")
    totals = found.agg(F.sum("n").alias("docs"), F.sum("weight").alias("weights")).first()
    if not totals["weights"]:
        return found.select("mix_source", F.lit(0.0).alias("rate")).limit(0)
    everything = float(docs.count())
    share = F.col("weight") / F.lit(float(totals["weights"]))
    return found.select("mix_source", (share * F.lit(size * everything) / F.col("n")).alias("rate"))


def row_key(doc_id: Column, text: Column) -> Column:
    """What a row draws and is sorted by: its id and a digest of its text."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))


def uniform(seed: int, draw: Column, key: Column) -> Column:
    """A number in [0, 1) from the first hex digits of a hash."""
    text = F.concat_ws("|", F.lit(str(seed)), draw.cast("string"), key)
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson(u: Column, rate: Column) -> Column:
    """The least n with u < P(X <= n) for X Poisson with mean ``rate``."""
    first = F.exp(-rate)
    start = F.struct(F.lit(0).alias("n"), first.alias("p"), first.alias("c"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.when(u >= s["c"], F.struct((s["n"] + 1).alias("n"), p.alias("p"), (s["c"] + p).alias("c"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["n"])


def copies(seed: int, key: Column, rate: Column) -> Column:
    """Poisson number of copies of a document, as the sum of draws with small means."""
    draws = F.greatest(F.lit(1), F.ceil(rate / DRAW_RATE).cast("int"))
    each = F.transform(
        F.sequence(F.lit(0), draws - 1),
        lambda d: F.element_at(F.transform(F.array(uniform(seed, d, key)), lambda u: poisson(u, rate / draws)), 1),
    )
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def mix(
    docs: DataFrame, weights: DataFrame, size: float = 1.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``docs`` replicated to the target weights, in a global random order, with ``copy`` from 1."""
    docs = docs.drop("copy")
    columns = docs.columns
    source, rate, times, key = (unused(c, columns) for c in ("mix_source", "mix_rate", "mix_times", "mix_key"))
    rated = rates(docs, weights, size, source_col).toDF(source, rate)
    if rated.count() <= BROADCAST_SOURCES:
        rated = F.broadcast(rated)  # beyond that an ordinary join, which adaptive execution can split
    joined = docs.join(rated, docs[source_col].eqNullSafe(F.col(source))).withColumn(key, row_key(docs[id_col], docs[text_col]))
    counted = joined.withColumn(times, copies(seed, F.col(key), F.col(rate))).where(F.col(times) > 0)
    kept = [F.col(f"`{c}`") for c in (*columns, key)]
    out = counted.select(*kept, F.explode(F.sequence(F.lit(1), F.col(times))).alias("copy"))
    return out.orderBy(F.xxhash64(F.lit(seed), F.col(key), F.col("copy")), F.col(key), F.col("copy")).drop(key)


def mix_sql(power: float = 0.5, seed: int = 17) -> str:
    """The same rows in DuckDB: ``documents`` mixed with tempered weights."""
    return f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rated AS (
  SELECT source, pow(n::DOUBLE, {power}) / (SELECT sum(pow(n::DOUBLE, {power})) FROM sizes)
    * (SELECT count(*) FROM documents)::DOUBLE / n AS rate FROM sizes),
parted AS (SELECT source, greatest(1, ceil(rate / {DRAW_RATE}))::INT AS draws, rate FROM rated),
terms AS (
  SELECT source, k, exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1)) AS p
  FROM parted, (SELECT unnest(range({TERMS}))::DOUBLE AS k)),
steps AS (SELECT source, list(c ORDER BY k) AS cs FROM (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(p.draws::BIGINT), lambda x: len(list_filter(s.cs, lambda c: c <=
    ('0x' || substr(md5('{seed}|' || x || '|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || md5(coalesce(d.text, ''))), 1, {DIGITS}))::BIGINT::DOUBLE / {16**DIGITS}.0)))) AS times
  FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
    JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, times::BIGINT + 1))::INT AS copy FROM drawn WHERE times > 0
"""
