"""Incident records, their log, and the search for similar ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.functions.code import send
from fieldwatch.functions.rules import bound, decimal_text, first_match, utc_text
from fieldwatch.operators import nearest as tiles
from fieldwatch.operators.anomaly import anomaly_type
from fieldwatch.operators.classify import compliance_flag

SEVERITY = [(1.0, "pump_alarm_level = 'L4_SHUTDOWN'"), (0.75, "pump_alarm_level = 'L3_CRITICAL'"), (0.5, "pump_alarm_level = 'L2_WARNING'"), (0.25, "pump_alarm_level = 'L1_ADVISORY'")]


def incident_records(events: DataFrame, *more: str) -> DataFrame:
    """A record per anomaly event, with more of its columns if named. Cause and life come from the rules; the component, free text elsewhere, stays null."""
    return events.select(
        "well_id", "facility_id", anomaly_type().alias("anomaly_type"), F.col("failure_mode").alias("root_cause"), F.lit(None).cast("string").alias("affected_component"),
        F.col("recommended_action").alias("immediate_action"), first_match(SEVERITY, 0.0).alias("severity"), compliance_flag().alias("compliance_flag"), utc_text(F.col("well_ts")).alias("generated_at"), *more,
    )


#: Stands for a component that no rule names.
NO_COMPONENT = "null"


def full_records(events: DataFrame, lives: DataFrame) -> DataFrame:
    """incident_records with estimated_rul: the remaining life that the pump report (well_id, timestamp, rul) gave at the event's time."""
    known = events.join(lives.select("well_id", F.col("timestamp").alias("well_ts"), F.col("rul").alias("estimated_rul")), ["well_id", "well_ts"])
    return incident_records(known, "estimated_rul", "well_ts")


def incident_texts(records: DataFrame) -> DataFrame:
    """Records with the text under which an incident is kept, its eight fields, and the text's hash as id."""
    fields = [("Well", F.col("well_id")), ("Facility", F.col("facility_id")), ("Type", F.col("anomaly_type")), ("Component", F.coalesce("affected_component", F.lit(NO_COMPONENT))), ("Cause", F.col("root_cause")), ("Action", F.col("immediate_action")), ("RUL", F.col("estimated_rul")), ("Severity", decimal_text(F.col("severity"), 2))]
    text = F.concat_ws(" | ", *[F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("null"))) for name, value in fields])
    return records.withColumn("content", text).withColumn("id", F.sha2(F.concat_ws("@", "content", "generated_at"), 256))


def _terms(texts: DataFrame, text: str, dims: int, *keys: str) -> DataFrame:
    """(keys, dim, tf): how often words of the text fall on each hashed dimension."""
    words = F.explode(F.array_remove(F.split(F.lower(text), "[^a-z0-9_]+"), "")).alias("w")
    return texts.select(*keys, words).groupBy(*keys, (F.conv(F.substring(F.md5("w"), 1, 5), 16, 10).cast("long") % dims).alias("dim")).agg(F.count("*").alias("tf"))


def _vectors(terms: DataFrame, weights: DataFrame, *keys: str) -> DataFrame:
    """(keys, dims, vals): the weighed dimensions of each key, in order."""
    weighed = terms.join(weights, "dim").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("dim", (F.col("tf") * F.col("idf")).alias("v")))).alias("t"))
    return weighed.select(*keys, F.col("t.dim").alias("dims"), F.col("t.v").alias("vals"))


def retrieve(questions: DataFrame, kept: DataFrame, k: int = 3, threshold: float = 0.0, dims: int = 1 << 20, parts: int = 16) -> DataFrame:
    """(question, id, cosine, rank): the k kept incidents (id, content) most like each distinct question text, by the cosine of hashed TF-IDF vectors.

    A dimension weighs tf times the logarithm of incidents over those that have it, as the kept incidents count it; dimensions of weight zero are left out. Equal contents have one vector, of which
    only the k smallest ids can be chosen. Blocks of vectors, ``parts`` at least, meet blocks of questions, each pair in one task that keeps the best of each question, so no row is
    made for a question and an incident. Ties go to the smaller id; cosines are compared at six places. Two counts reach the driver.
    """
    send(kept.sparkSession)
    asked = questions.select("question").filter("question IS NOT NULL").distinct()
    parts, q_parts = max(parts, tiles.blocks(kept.count(), tiles.DATA_BLOCK)), tiles.blocks(asked.count(), tiles.QUERY_BLOCK)
    whole = kept.groupBy("id").agg(F.concat_ws(" ", F.sort_array(F.collect_list("content"))).alias("content"))  # an id that comes twice has all its words
    logged = whole.withColumn("text", F.unhex(F.sha2("content", 256)))
    texts = logged.groupBy("text", "content").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    terms = _terms(texts, "content", dims, "text", "copies", "first")
    total = kept.agg(F.count("*").alias("total"))  # one row
    weights = terms.groupBy("dim").agg(F.sum("copies").alias("df")).join(F.broadcast(total)).select("dim", F.ln(F.col("total") / F.col("df")).alias("idf")).filter("idf > 0")
    rows = _vectors(terms.filter("first IS NOT NULL"), weights, "text", "first")
    rows = rows.select(F.col("text").alias("key"), "first", "dims", "vals", tiles.block_of(parts, "text").alias("d"), tiles.every(q_parts).alias("q"), F.lit(False).alias("asks"))
    asks = _vectors(_terms(asked, "question", dims, "question"), weights, "question")
    none = F.lit(None).cast(kept.schema["id"].dataType).alias("first")
    asks = asks.select(F.col("question").cast("binary").alias("key"), none, "dims", "vals", tiles.every(parts).alias("d"), tiles.block_of(q_parts, "question").alias("q"), F.lit(True).alias("asks"))
    best = lambda tile: tiles.matching(tile, k, threshold)
    found = rows.unionByName(asks).groupBy("d", "q").applyInPandas(best, f"question binary, text binary, first {kept.schema['id'].dataType.simpleString()}, cosine double")
    rank = lambda key, *by: F.row_number().over(Window.partitionBy(key).orderBy(*by))
    found = found.withColumn("rank", rank("question", F.desc("cosine"), "first")).filter(F.col("rank") <= k).select(F.col("question").cast("string"), "text", "cosine")
    ids = logged.filter("id IS NOT NULL").select("text", "id").withColumn("nth", rank("text", "id")).filter(F.col("nth") <= k).drop("nth")
    return found.join(ids, "text").withColumn("rank", rank("question", F.desc("cosine"), "id")).filter(F.col("rank") <= k).select("question", "id", "cosine", "rank")


def question_of() -> Column:
    """What is asked for an incident record: its type, cause and action."""
    return F.concat_ws(" ", "anomaly_type", "root_cause", "immediate_action")


def incident_log(records: DataFrame) -> DataFrame:
    """The text and metadata under which an incident is kept."""
    metadata = F.create_map(
        *[x for name, c in (("wellId", "well_id"), ("facilityId", "facility_id"), ("anomalyType", "anomaly_type"), ("timestamp", "generated_at")) for x in (F.lit(name), F.col(c))],
        F.lit("severity"), decimal_text(F.col("severity"), 2),
    )
    return incident_texts(records).select("id", "content", metadata.alias("metadata"), "generated_at")


def similar_incidents(queries: DataFrame, corpus: DataFrame, k: int = 3, threshold: float = 0.70, cells: int = 16, salts: int = 4) -> DataFrame:
    """query_id, vec_id and cosine of the k most similar corpus vectors of each query, none below the threshold and never the query itself.

    Exact. Corpus vectors belong to the nearest of ``cells`` fixed pivot directions; a query meets a cell only if its angle to the pivot, less the cell's
    largest angle, is within the threshold's: angles obey the triangle inequality, so nothing is lost for any number of cells. Each cell is
    divided into as many blocks as the corpus needs, ``salts`` at least, and so are the queries; a block pair is compared in one task. On vectors without clusters little is pruned.
    Two counts reach the driver.
    """
    send(corpus.sparkSession)
    salts, parts = max(salts, tiles.blocks(corpus.count(), tiles.DATA_BLOCK)), tiles.blocks(queries.count(), tiles.QUERY_BLOCK)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(dot(v, v))
    unit = lambda df: df.filter(norm(F.col("embedding")) > 0).withColumn("v", bound(norm(F.col("embedding")), lambda n: F.transform("embedding", lambda x: x.cast("double") / n)))

    def pivots(v: Column) -> Column:
        """The angle to each pivot; pivot p points along axis p, or against it in every other round of the axes."""
        along = lambda p: F.get(v, F.pmod(p, F.size(v))) * F.when(F.pmod((p / F.size(v)).cast("int"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
        angle = lambda p: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), along(p))))
        return F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda p: F.struct(angle(p).alias("angle"), p.alias("cell")))

    nearest = bound(F.col("v"), lambda v: F.struct(v.alias("v"), F.array_min(pivots(v)).alias("near"))).alias("s")
    known = unit(corpus).filter("vec_id IS NOT NULL")
    mine = known.select("vec_id", nearest).select("vec_id", "s.v", "s.near.angle", "s.near.cell").withColumn("salt", tiles.block_of(salts, "vec_id", "v"))
    radii = mine.groupBy("cell").agg(F.max("angle").alias("radius"))  # at most ``cells`` rows
    asked = unit(queries).filter("vec_id IS NOT NULL").select(F.col("vec_id").alias("id"), "v", F.explode(bound(F.col("v"), pivots)).alias("p")).select("id", "v", "p.*")
    within = F.acos(F.lit(threshold)) + 1e-9
    visits = asked.join(F.broadcast(radii), "cell").filter(F.col("angle") - F.col("radius") <= within)
    pairs = visits.select("id", "v", "cell", tiles.every(salts).alias("salt"), tiles.block_of(parts, "id", "v").alias("part"), F.lit(True).alias("asks"))
    pairs = pairs.unionByName(mine.select(F.col("vec_id").alias("id"), "v", "cell", "salt", tiles.every(parts).alias("part"), F.lit(False).alias("asks")))
    kind = corpus.schema["vec_id"].dataType.simpleString()
    best = lambda tile: tiles.similar(tile, k, threshold)
    near = pairs.groupBy(F.size("v"), "cell", "salt", "part").applyInPandas(best, f"query_id {kind}, vec_id {kind}, cosine double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)
