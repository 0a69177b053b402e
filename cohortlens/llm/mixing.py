"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tables import WORD, Scratch, running_sums, spare_name

LEAST_QUALITY = 0.05


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """Letters among the visible characters, 0.05 at least: symbol junk is drawn last."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    seen = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(letters / F.nullif(seen, F.lit(0)), F.lit(0.0)))


def exponential_key(ident: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u drawn from the document's id and text: small keys first."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(":"),
                            F.coalesce(F.md5(text), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size) with ``target``: ``share`` of all words by weight, no source
    above ``most`` times its size, the excess reshared by weight among the others.

    Sources take the weights in turn, by code point of their name, NULL last. A source is
    capped when the level per unit of weight reaches its cap, so sorting by cap per
    weight settles all rounds of resharing in one pass over the table of sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("_w", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    whole = Window.partitionBy()
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto = rising.rowsBetween(Window.unboundedPreceding, -1)
    ranked = named.withColumn("_cap", F.lit(float(most)) * F.col("source_size")).withColumns({
        "_capped": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)),
        "_left": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)),
        "_all": F.lit(float(share)) * F.sum("source_size").over(whole),
    })
    level = (F.col("_all") - F.col("_capped")) / F.col("_left")
    # the first level that caps nobody holds for every source from there on
    free = ranked.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    settled = free.withColumn("_level", F.first("_level", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, 0)))
    return settled.select("source", "source_size", F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")).alias("target"))


def mix_sources(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11,
                ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken`` words.

    A source whose target is e full epochs and a rest takes every document e times; the
    rest goes to documents in order of their exponential key while the middle of the
    document lies within the budget, so the source misses its target by half a document
    at most. Only a narrow table (id, digest, size, key) is sorted, in ranges, so a hot
    source is no hot task; whole rows are met again by the cut of their source, without
    a shuffle. Rows alike in id and text are one draw and share its outcome. NULL text
    has size 0 and takes nothing; NULL source is a source of its own; NULL ids draw by
    their text. Columns with the added names are replaced. An empty frame stays empty.
    """
    scratch = Scratch(docs.sparkSession)
    base = docs.drop("size", "source_size", "target", "taken")
    key, digest, src, weight = (spare_name(base, c) for c in ("_key", "_digest", "_source", "_weight"))
    keyed = base.withColumns({"size": word_count(text), weight: quality_weight(text), digest: F.coalesce(F.md5(F.col(text)), F.lit("")),
                              src: F.col(source).cast("string")}).withColumn(key, exponential_key(F.col(ident), F.col(text), F.col(weight), seed))
    narrow = keyed.select(F.col(src).alias("source"), F.col(ident).cast("string").alias("ident"), F.col(digest).alias("digest"),
                          F.col("size").alias("size"), F.col(key).alias("key"))
    draws = scratch.keep(narrow.groupBy("source", "key", "ident", "digest").agg(F.sum("size").alias("words")), "draws")
    targets = scratch.keep(source_targets(draws.groupBy("source").agg(F.sum("words").alias("source_size")), list(weights), share, most), "targets")
    summed = running_sums(draws, "source", ["key", "ident", "digest"], "words", scratch)
    a, b = summed.alias("a"), targets.alias("b")
    budget = F.col("target") - F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))) * F.col("source_size")
    met = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).where((F.col("upto") - F.col("words") / 2.0 <= budget) & (F.col("words") > 0))
    cuts = met.groupBy(F.col("a.source").alias("source")).agg(F.max(F.struct("key", "ident", "digest")).alias("cut"))
    c = cuts.alias("c")
    plan = scratch.keep(b.join(c, F.col("b.source").eqNullSafe(F.col("c.source")), "left").select("b.*", "c.cut"), "mix-plan")
    of = {x: spare_name(keyed, f"plan_{x}") for x in plan.columns}
    plan = plan.select(*[F.col(x).alias(y) for x, y in of.items()])
    joined = keyed.join(plan, F.col(src).eqNullSafe(F.col(of["source"])), "left")
    own = F.struct(F.col(key).alias("key"), F.col(ident).cast("string").alias("ident"), F.col(digest).alias("digest"))
    epochs = F.coalesce(F.floor(F.col(of["target"]) / F.nullif(F.col(of["source_size"]), F.lit(0))), F.lit(0))
    drawn = F.coalesce((own <= F.col(of["cut"])), F.lit(False)).cast("long")
    return joined.withColumns({
        "source_size": F.col(of["source_size"]), "target": F.col(of["target"]),
        "taken": F.least(epochs + drawn, F.lit(int(most))) * F.col("size"),
    }).drop(key, digest, src, weight, *plan.columns)


# The same mix in SQL, with the parameters of op8_mix.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, CAST(source AS VARCHAR) AS source, COALESCE(md5(text), '') AS digest,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         GREATEST(0.05::DOUBLE, COALESCE(length(regexp_replace(text, '[^\p{L}]', '', 'g'))
           / NULLIF(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')), 0)::DOUBLE, 0)) AS w,
         md5('11:' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || COALESCE(md5(text), 'null')) AS h
  FROM documents),
k AS (SELECT *, -ln((CAST('0x' || substr(h, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / w AS key FROM d),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM k GROUP BY 1),
n AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS pos FROM n),
l AS (SELECT *, (1.5::DOUBLE * SUM(source_size) OVER () - COALESCE(SUM(cap) OVER before, 0))
               / (SUM(w) OVER () - COALESCE(SUM(w) OVER before, 0)) AS lvl
      FROM r WINDOW before AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, arg_min(lvl, pos) FILTER (WHERE lvl * w <= cap) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS level FROM l),
t AS (SELECT source, source_size, COALESCE(level * w, cap) AS target FROM f),
u AS (SELECT k.*, t.source_size, t.target,
             SUM(size) OVER (PARTITION BY k.source ORDER BY key, CAST(doc_id AS VARCHAR), digest) AS upto,
             SUM(size) OVER (PARTITION BY k.source, key, doc_id, digest) AS words
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(COALESCE(floor(target / NULLIF(source_size, 0)), 0) AS BIGINT) * size
         + CASE WHEN upto - words / 2.0::DOUBLE <= target - floor(target / NULLIF(source_size, 0)) * source_size THEN size ELSE 0 END AS taken
FROM u
"""
