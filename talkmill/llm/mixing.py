"""Documents of several sources mixed to target shares of the total size.

Sizes are tokens of a public tokenizer. The total is the largest at which every source that has documents reaches
its share without any document being used more than its source's max_repeats times (or a smaller one that is
asked for). A source's budget is filled with complete epochs first; the rest is a weighted sample without
replacement after Efraimidis and Spirakis: each document draws an exponential key scaled by its quality weight,
and the shortest prefix order of the keys is cut where the token budget is reached.

No source is sorted as a whole: the keys of a source are split into BUCKETS ranges, token sums per range give the one
in which the cut lies, and that one is split again between its own least and greatest key until it holds at most LEAF
documents, however the weights crowd the keys. Only these are ordered exactly; the result is that of a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkmill.llm.tokens import encode, vocabulary_path
from talkmill.session import written

#: Ranges of sampling keys per source and round, and documents that are ordered exactly. They change no result.
BUCKETS, LEAF = 4096, 10_000
SEED = 20250501


def quality(text: str = "text") -> Column:
    """Weight in [0.05, 1]: the share of letters among the characters, lower for very short texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", "")) / F.greatest(F.length(t), F.lit(1))
    return F.greatest(F.lit(0.05), F.least(F.lit(1.0), letters * F.least(F.lit(1.0), F.length(t) / 100)))


def sized(documents: DataFrame, weight: Column | None = None, vocabulary: str | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, print (of id and text), key (the sampling key, smaller ones first) of each document with tokens, as a written table."""
    key = F.struct("doc_id", "source", F.xxhash64("doc_id", "text").alias("print"), (weight if weight is not None else quality()).cast("double").alias("w"))
    counted = encode(documents.select(key.alias("k"), "text"), "k", "text", vocabulary or vocabulary_path(), counts_only=True)
    uniform = (F.shiftrightunsigned(F.xxhash64("k.print", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    rows = counted.select("k.doc_id", "k.source", "n_tokens", "k.print", (-F.log(uniform) / F.greatest(F.coalesce("k.w", F.lit(0.0)), F.lit(1e-6))).alias("key"))
    return written(rows.where("n_tokens > 0"), "sized")


def budgets(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """source, target_share, max_repeats, available (tokens), n_docs, epochs, rest (tokens of the fractional epoch) of each target or source with documents."""
    have = docs.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n_docs"))
    want = targets.where("source IS NOT NULL").groupBy("source").agg(F.sum(F.greatest("target_share", F.lit(0.0))).alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = want.join(have, "source", "full").select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"), F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
    most = F.when((F.col("target_share") > 0) & (F.col("available") > 0) & (F.col("max_repeats") > 0), F.col("max_repeats") * F.col("available") / F.col("target_share"))
    both = written(both, "mix-sources")
    limit = both.agg(F.min(most)).first()[0] or 0.0  # one number
    wanted = min(limit, float(total_tokens)) if total_tokens is not None else limit
    usable = F.when((F.col("available") > 0) & (F.col("max_repeats") > 0), F.col("target_share")).otherwise(0.0)
    budget = usable * F.lit(wanted)
    epochs = F.when(F.col("available") > 0, F.least(F.floor(budget / F.col("available") + 1e-9), F.col("max_repeats"))).otherwise(0).cast("long")
    done = both.select(*both.columns, budget.alias("budget"), epochs.alias("epochs"))
    return done.withColumn("rest", F.when(F.col("epochs") < F.col("max_repeats"), F.greatest(F.col("budget") - F.col("epochs") * F.col("available"), F.lit(0.0))).otherwise(0.0))


def _cuts(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """source, epochs, rest, lo, hi, before: the fractional epoch takes the keys below lo, and of those from lo to hi what
    fits behind the `before` tokens below lo. One row per source with a budget; they're as few as the targets."""
    spark = docs.sparkSession
    wanted = plan.where("epochs > 0 OR rest > 0").select("source", "epochs", "rest")
    ends = docs.groupBy("source").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n"))
    rows = {r["source"]: r.asDict() | {"before": 0} for r in wanted.join(ends, "source").collect()}
    schema = "source string, epochs long, rest double, lo double, hi double, n long, before long"
    table = lambda some: spark.createDataFrame([tuple(r[c] for c in ("source", "epochs", "rest", "lo", "hi", "n", "before")) for r in some], schema)
    settled = {s for s, r in rows.items() if r["rest"] <= 0}
    for s in settled:
        rows[s] |= {"lo": float("-inf"), "hi": float("-inf")}
    while open_ := [r for s, r in rows.items() if s not in settled and r["n"] > LEAF and r["hi"] > r["lo"]]:
        inside = docs.join(F.broadcast(table(open_).select("source", "rest", "lo", "hi", "before")), "source").where("key >= lo AND key <= hi")
        spot = F.least(F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS), F.lit(BUCKETS - 1))
        fill = inside.groupBy("source", "rest", "before", spot.alias("bucket")).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        through = F.col("before") + F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        first = fill.withColumn("through", through).where("through > rest").groupBy("source").agg(F.min_by(F.struct("lo", "hi", "n", (F.col("through") - F.col("tokens")).alias("before")), "bucket").alias("x")).select("source", "x.*")
        found = {r["source"]: r.asDict() for r in first.collect()}
        for r in open_:
            if r["source"] in found:
                r |= found[r["source"]]
            else:  # all of it fits
                r |= {"lo": float("inf"), "hi": float("inf")}
                settled.add(r["source"])
    return table(rows.values())


def mix(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, weight: Column | None = None, vocabulary: str | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mixture (doc_id, source, n_tokens, copies) and its report per source.

    copies is how often a document is used, at least 1; documents that aren't used, that have no tokens (null or
    empty texts) or whose source has no target are left out. The report has a row for each target and each source
    with documents: target_share, share (really reached), tokens, n_docs, n_used, epochs, max_repeats; a source
    without documents has share 0, and the others keep their proportions. A null source has no target. Keys come
    from id and text, so rows with the same doc_id are separate documents, and only rows equal in both share a key (one
    of them is as good as another). Extra columns are ignored.
    No documents or no targets: an empty mixture. Same input and seed, same mixture, at any partitioning.
    """
    docs = sized(documents, weight, vocabulary, seed)
    plan = written(budgets(docs, targets, total_tokens), "mix-budgets")
    # one row per target: bounded by the list of targets, which is a setting
    marked = docs.join(F.broadcast(_cuts(docs, plan)), "source")
    exact = Window.partitionBy("source").orderBy("key", "doc_id", "print").rowsBetween(Window.unboundedPreceding, 0)
    inside = (F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi"))
    edge = marked.where(inside).withColumn("more", ((F.col("before") + F.sum("n_tokens").over(exact)) <= F.col("rest")).cast("int"))
    others = marked.where(~inside).withColumn("more", (F.col("key") < F.col("lo")).cast("int"))
    mixed = edge.unionByName(others).select("doc_id", "source", "n_tokens", (F.col("epochs") + F.col("more")).cast("long").alias("copies")).where("copies > 0")
    mixed = written(mixed, "mixture")
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("n_used"))
    total = used.agg(F.sum("tokens")).first()[0] or 1  # one number
    report = plan.join(used, "source", "left").select("source", "target_share", F.coalesce(F.col("tokens") / F.lit(total), F.lit(0.0)).alias("share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "n_docs", F.coalesce("n_used", F.lit(0)).alias("n_used"), "epochs", "max_repeats")
    return mixed, report


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/mix_targets.parquet"))[0]


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/mix_targets.parquet"))[1]
