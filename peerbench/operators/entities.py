"""Resolving requests to entities.

Entity rows carry file, sheet, file_ord, sheet_ord, row_idx, holding, universe,
sub_industry, focus, id. "First" always means first by (file_ord, sheet_ord,
row_idx), whatever way the rows are spread over partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.constants import MIN_NAME_LENGTH
from peerbench.functions.labels import entity_name
from peerbench.functions.text import norm_key, strip
from peerbench.operators.joins import ORDER, by_shuffle, first_by, first_per_key, lookup, only
from peerbench.operators.name_index import BEST, FACTS, NameIndex, gram_size, grams_of, name_texts, needles, rarest_gram
from peerbench.session import durable


def with_name(df: DataFrame) -> DataFrame:
    return df.withColumn("name", entity_name(F.col("holding"), F.col("universe"), F.col("id")))


def find_by_id(wanted: DataFrame, entities: DataFrame) -> DataFrame:
    """First entity row per wanted id (column id); ids compare trimmed, any case.

    Only rows with a wanted id are shuffled.
    """
    keys = wanted.select(norm_key(F.col("id")).alias("key"))
    hits = only(entities.withColumn("key", norm_key(F.col("id"))), keys, ["key"], ORDER)
    found = first_per_key(hits, ["key"], ["id", *FACTS])
    return with_name(found.withColumn("id", strip(F.col("id"))))


def resolve_by_id(requests: DataFrame, entities: DataFrame) -> DataFrame:
    """Requests with an id joined to their entity; unknown ids keep null facts."""
    wanted = requests.where(F.col("id").isNotNull()).select("row_number", "id")
    found = find_by_id(wanted, entities).withColumnRenamed("id", "entity_id")
    return (
        wanted.withColumn("key", norm_key(F.col("id")))
        .join(by_shuffle(found), "key", "left")
        .select("row_number", "entity_id", "name", "sub_industry", "focus")
    )


def find_by_name(wanted: DataFrame, entities: DataFrame | NameIndex) -> DataFrame:
    """First entity whose name contains a wanted name (column needle, lower case).

    A name contains a needle only if it contains each of the needle's parts of one size, so each needle is
    filed under its rarest part, names meet needles by that part, and are then verified.
    An index that was written before knows how rare a trigram is among the names. An entity table is read
    once, with each needle under the part that the fewest needles have; only hits are shuffled. Those parts are
    as long as a needle allows: there are so few trigrams that the needles of one grow with all needles. Within
    a sheet a hit in holding beats a hit in universe; the first sheet with a hit wins.
    """
    if isinstance(entities, NameIndex):
        return _named(entities.find(wanted))
    sought = needles(wanted)
    size = gram_size(F.col("needle"))
    seen = grams_of(sought, size).groupBy("gram").agg(F.count("*").alias("n"))
    rarest = rarest_gram(sought, seen, size)
    filed = durable(rarest.select("needle", F.length("gram").alias("size"), F.xxhash64("gram").alias("gram")))
    sizes = [x["size"] for x in filed.select("size").distinct().collect()]  # some of SIZES
    cut = _cut(name_texts(entities), sizes)
    hits = lookup(cut, filed.select("needle", "gram"), ["gram"], spread=["text", "row_idx"], within=filed)
    hits = hits.where(F.contains("text", "needle"))
    return _named(first_per_key(hits, ["needle"], ["id", *FACTS], list(BEST)))


def _cut(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """A row per text and part of one of the sizes: the part's hash (gram), as what meets by it is compared whole."""
    last = F.length("text") - F.col("_size") + 1
    each = texts.withColumn("_size", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<int>")))
    each = each.withColumn("_at", F.explode(F.when(last > 0, F.sequence(F.lit(1), last))))
    return each.withColumn("gram", F.xxhash64(F.substring("text", F.col("_at"), F.col("_size")))).drop("_size", "_at")


def _named(found: DataFrame) -> DataFrame:
    return with_name(found.withColumn("id", strip(F.col("id"))))


def resolve_by_name(requests: DataFrame, entities: DataFrame | NameIndex) -> DataFrame:
    """Requests looked up by name; unknown names keep null facts."""
    wanted = requests.select("row_number", F.lower("name").alias("needle"))
    found = find_by_name(wanted, entities).withColumnRenamed("id", "entity_id")
    return wanted.join(by_shuffle(found), "needle", "left").select(
        "row_number", "entity_id", "name", "sub_industry", "focus"
    )


def name_to_id(names: DataFrame, entities: DataFrame) -> DataFrame:
    """Id of the first entity whose holding equals a name in any case; '' if none."""
    wanted = names.select("name").distinct().withColumn("key", F.lower("name"))
    hits = only(entities.withColumn("key", F.lower("holding")), wanted, ["key"], ORDER)
    found = first_per_key(hits, ["key"], ["id"])
    return wanted.join(by_shuffle(found), "key", "left").select("name", F.coalesce("id", F.lit("")).alias("id"))


def id_to_name(ids: DataFrame, entities: DataFrame) -> DataFrame:
    """Holding of the first row with an id; '' for unknown ids."""
    wanted = ids.select("id").distinct().withColumn("key", norm_key(F.col("id")))
    hits = only(entities.withColumn("key", norm_key(F.col("id"))), wanted, ["key"], ORDER)
    found = hits.groupBy("key").agg(first_by(F.col("holding"), ORDER).alias("name"))
    return wanted.join(by_shuffle(found), "key", "left").select("id", F.coalesce("name", F.lit("")).alias("name"))


def resolve(requests: DataFrame, entities: DataFrame, names: NameIndex | None = None) -> DataFrame:
    """Cleaned requests joined to the entity found by id or by name; others drop out.

    Names are searched in the index ``names`` where there is one.

    A row found by name opens its group even if it has no id.
    """
    by_name = requests.where(
        F.col("id").isNull() & (F.length("name") >= MIN_NAME_LENGTH)
    )
    found = resolve_by_id(requests, entities).unionByName(resolve_by_name(by_name, names or entities))
    return found.where(F.col("entity_id").isNotNull() | F.col("name").isNotNull())
