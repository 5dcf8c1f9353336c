"""Reports over documents, pages, sessions and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

#: Stages in order.
STAGES = ("crawl", "clean", "dedup", "weight", "tokenize", "shard", "train", "export")


def source_stats(docs: DataFrame, least_words: int = 30) -> DataFrame:
    n = X.word_count(F.col("text"))
    return docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(n).cast("long").alias("n_words"), F.sum(F.length("text")).cast("long").alias("n_chars"), F.count_if(n < least_words).alias("n_short"))


def domain_report(scored: DataFrame, window: int = 20, domain: str = "domain", score: str = "score", order: str = "ord", salts: int = 64) -> DataFrame:
    """Mean of the last `window` scores of each domain, its pages, and its bucket."""
    last = lambda rows, *keys: rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where(F.col("_n") <= window)
    # The last of each salt first, so that a large domain is dealt out, then the last of these.
    some = last(scored.select(F.struct(domain).alias("_key"), order, score).withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts))), "_key", "_salt")
    recent = last(some, "_key").groupBy("_key").agg(F.avg(score).alias("avg_score"))
    counted = scored.groupBy(F.struct(domain).alias("_key")).agg(F.count("*").alias("n_pages"))
    out = counted.join(recent, "_key").select(F.col(f"_key.{domain}").alias(domain), "avg_score", "n_pages")
    return out.withColumn("bucket", F.when(F.col("avg_score") >= 0.6, "high").when(F.col("avg_score") >= 0.35, "medium").otherwise("low"))


def dedup_stats(keys: DataFrame, key: str) -> DataFrame:
    """total, kept, dropped and the share dropped, if one row of each key is kept."""
    groups = keys.groupBy(key).agg(F.count("*").alias("n"))
    total = groups.agg(F.sum("n").alias("total"), F.count("*").alias("kept"))
    return total.select("total", "kept", (F.col("total") - F.col("kept")).alias("dropped"), ((F.col("total") - F.col("kept")) / F.col("total")).alias("dropped_share"))


def weight_stats(weighted: DataFrame, n_in: DataFrame) -> DataFrame:
    """docs_in, total_weight, avg_weight, docs_out and expansion, from rows before (with final_weight) and after."""
    both = n_in.select("final_weight", F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(weighted.select(F.lit(None).cast("double").alias("final_weight"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    out = both.agg(F.sum("i").alias("docs_in"), F.sum("final_weight").alias("total_weight"), F.avg("final_weight").alias("avg_weight"), F.sum("o").alias("docs_out"))
    return out.withColumn("expansion", F.col("docs_out") / F.col("docs_in"))


def session_state(stages: DataFrame) -> DataFrame:
    """State of each dataset from its stage rows (dataset_id, stage, status): complete over trained over running over collected."""
    has = lambda s, v: F.max(((F.col("stage") == s) & (F.col("status") == v)).cast("int")) == 1
    running = F.max((F.col("status") == "running").cast("int")) == 1
    return stages.groupBy("dataset_id").agg(F.when(has("export", "complete"), "COMPLETE").when(has("train", "complete"), "TRAINED").when(running, "RUNNING").otherwise("COLLECTED").alias("state"))


def latest_available(tables: list[tuple[int, DataFrame]], key: str) -> DataFrame:
    """For each key the row of the highest priority among the tables."""
    out = None
    for priority, t in tables:
        t = t.withColumn("_p", F.lit(priority))
        out = t if out is None else out.unionByName(t)
    rest = [c for c in out.columns if c not in (key, "_p")]
    return out.groupBy(key).agg(F.max_by(F.struct(*rest), "_p").alias("r")).select(key, "r.*")


def tail(events: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last n rows in order."""
    return events.orderBy(*(F.desc(c) for c in order)).limit(n)


def perplexity(metrics: DataFrame, loss: str = "loss") -> DataFrame:
    return metrics.agg(F.avg(loss).alias("mean_loss")).withColumn("perplexity", F.exp(F.least("mean_loss", F.lit(20.0))))


def cosine_lr(step: Column, warmup: int, total: int, peak: float, floor: float) -> Column:
    """The learning rate of a step: linear up to the peak, then half a cosine down to the floor, which stays."""
    share = (step - warmup) / F.lit(max(total - warmup, 1))
    down = F.lit(floor) + F.lit((peak - floor) / 2) * (F.cos(share * F.pi()) + 1)
    return F.when(step < warmup, F.lit(peak) * step / F.lit(max(warmup, 1))).when(step > total, F.lit(floor)).otherwise(down)


def parameter_count(models: DataFrame) -> DataFrame:
    """models (vocabulary, layers, heads, kv_heads, width, inner) of decoders with gated feed-forward layers, with n_parameters."""
    kv = F.floor(F.col("width") / F.col("heads")) * F.col("kv_heads")
    layer = 2 * F.col("width") * (F.col("width") + kv) + 3 * F.col("width") * F.col("inner") + 2 * F.col("width")
    return models.withColumn("n_parameters", (2 * F.col("vocabulary") * F.col("width") + F.col("layers") * layer + F.col("width")).cast("long"))


def next_id(ids: DataFrame, column: str) -> DataFrame:
    return ids.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("next_id"))


def unseeded_groups(groups: DataFrame, sessions: DataFrame) -> DataFrame:
    """Groups that have no session yet."""
    return groups.join(sessions.select("group_id"), "group_id", "left_anti")


def group_configs(sessions: DataFrame, groups: DataFrame) -> DataFrame:
    """Sessions with their group's configuration, their own where the group is unknown."""
    return sessions.join(groups.select("group_id", F.col("config").alias("_config")), "group_id", "left").withColumn("config", F.coalesce("_config", "config")).drop("_config")


def crawl_stats(attempts: DataFrame) -> DataFrame:
    """Pages fetched, skipped, failed and abandoned by source, of attempts (source, outcome)."""
    return attempts.groupBy("source").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("fetched", "skipped", "error", "abandoned")))


def output_inventory(files: DataFrame, depth: int) -> DataFrame:
    """Files and bytes below each folder that is `depth` names deep in the paths of files (path, size)."""
    root = F.array_join(F.slice(F.split(F.regexp_replace("path", r"^[a-z]+:/+", ""), "/"), 1, depth), "/")
    return files.groupBy(root.alias("root")).agg(F.count("*").alias("files"), F.sum("size").cast("long").alias("bytes"))


def session_stats(documents: DataFrame) -> DataFrame:
    """Documents and words of each dataset, of rows (dataset_id, text)."""
    return documents.groupBy("dataset_id").agg(F.count("*").alias("documents"), F.sum(X.word_count(F.col("text"))).cast("long").alias("words"))


def superseded(artifacts: DataFrame, keep: int = 3, group: str = "kind", order: str = "step") -> DataFrame:
    """Artifacts beyond the `keep` newest of each kind."""
    return artifacts.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(order)))).where(F.col("_n") > keep).drop("_n")
