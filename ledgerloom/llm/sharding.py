"""Shards by fixed virtual slots, in DataFrame and SQL functions only.

Every record hashes by its id and text into one of thousands of slots, for ever. Bytes are
summed per slot (combined on the map side), and slots, largest first, go to the shard with the
fewest bytes so far: shards end up nearly equal in bytes, since thousands of small slots can
always fill the gaps. The slot-to-shard map is a small table, written under a version; growing
edits the map by moving a few slots into the new shard, so no record rehashes and no other one
moves.

The map has one row per slot, whatever the number of records. Rows are numbered within portions
of a slot, as many as its rows call for, so a slot of any size is numbered by many tasks. The
portions' counts, slots and a millionth of the rows at most, are broadcast with the map.

Groups of equal texts do not stay together: the law is equal bytes, and a group may be a third
of all rows. Its records have ids of their own and so go to different slots.

Defined cases: null texts have no bytes of their own; a record without id is its place in the
written table, so null ids are spread; rows that repeat an id with another text are records of
their own, and copies of a whole row share its slot and are numbered each; extra columns stay
out of the result; an empty table gives an empty result, and its map deals the empty slots out
evenly.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.common import keep, utf8
from ledgerloom.session import scratch_path

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16
#: Rows of a portion of a slot that one task numbers.
PORTION_ROWS = 1_000_000


def record_slots(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, place, virtual_slot) of every row; write it once.

    `place` numbers the rows as they are read. It stands for an id that is null, and chooses a
    portion of a large slot.
    """
    numbered = documents.select("doc_id", utf8("text").alias("text")).withColumn(
        "place", F.monotonically_increasing_id()
    )
    record = F.when(F.col("doc_id").isNull(), F.xxhash64("place", F.lit("no id")))
    return numbered.select(
        "doc_id",
        (F.octet_length("text").cast("long") + ROW_BYTES).alias("size"),
        F.crc32("text").alias("text_crc32"),
        "place",
        F.pmod(record.otherwise(F.xxhash64("doc_id", "text")), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(spark: SparkSession, records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, n_rows, n_bytes) of all slots, empty ones included."""
    summed = records.groupBy("virtual_slot").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes")
    )
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(summed), "virtual_slot", "left").na.fill(0, ["n_rows", "n_bytes"])


def deal_slots(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(virtual_slot, shard): largest slots first, each to the shard with the fewest bytes.

    An empty slot counts as a row without text, or one shard would take them all. The sizes of all slots stand in one sorted array (slots are a fixed number), and a fold
    over it carries the bytes of the shards.
    """
    ordered = sizes.agg(
        F.sort_array(F.collect_list(F.struct("n_bytes", "virtual_slot")), asc=False).alias("slots")
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<int>").alias("chosen"),
    )

    def place(state, slot):
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        weight = F.greatest(slot["n_bytes"], F.lit(ROW_BYTES).cast("long"))
        loads = F.transform(
            state["loads"], lambda load, i: F.when(i == least - 1, load + weight).otherwise(load)
        )
        return F.struct(loads.alias("loads"), F.array_append(state["chosen"], least - 1).alias("chosen"))

    dealt = ordered.select("slots", F.aggregate("slots", start, place)["chosen"].alias("chosen"))
    pairs = dealt.select(F.explode(F.arrays_zip("slots", "chosen")).alias("p"))
    return pairs.select(F.col("p.slots.virtual_slot").alias("virtual_slot"), F.col("p.chosen").alias("shard"))


def grow(sizes: DataFrame, assigned: DataFrame, shards: int) -> DataFrame:
    """The map with one more shard (number `shards`): every old shard gives up slots in the
    order of a hash, as long as both their number and their bytes are within the new shard's
    equal part; all others stay. Empty slots move like others, for they will be filled."""
    rows = assigned.join(sizes, "virtual_slot")
    mine = Window.partitionBy("shard")
    order = mine.orderBy(F.xxhash64("virtual_slot", F.lit(shards)), "virtual_slot")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    part = 1 / (shards + 1)
    # A slot goes if its middle is within the part, so that parts are met on average.
    bytes_upto = F.coalesce(F.sum("n_bytes").over(before), F.lit(0)) + F.col("n_bytes") / 2
    slots_upto = F.row_number().over(order) - 0.5
    moves = (bytes_upto <= F.sum("n_bytes").over(mine) * part) & (
        slots_upto <= F.count(F.lit(1)).over(mine) * part
    )
    return rows.withColumn("moves", moves).select(
        "virtual_slot", F.when(F.col("moves"), shards).otherwise(F.col("shard")).alias("shard")
    )


def store_map(assigned: DataFrame, root: str, version: int) -> DataFrame:
    """Write a slot-to-shard map under its version; an existing version is never replaced."""
    path = f"{root}/version={version}"
    assigned.coalesce(1).write.parquet(path)
    spark = assigned.sparkSession
    return spark.read.schema(assigned.schema).parquet(path)


def read_map(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A stored map: the given version, or the latest."""
    stored = spark.read.parquet(root)
    wanted = F.lit(version) if version is not None else F.lit(stored.agg(F.max("version")).first()[0])
    return stored.filter(F.col("version") == wanted).drop("version")


def shard(
    documents: DataFrame,
    shards: int = SHARDS,
    slots: int = SLOTS,
    root: str | None = None,
    portion_rows: int = PORTION_ROWS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, rebalanced_shard).

    The map is stored as version 1, and edited for one more shard as version 2;
    `rebalanced_shard` is the row's shard by version 2. `grown_shard` is null under this law.

    `slot` numbers the rows of a shard without gaps: rows are numbered within their portion of
    a virtual slot, on top of the rows in the shard's earlier portions.
    """
    spark = documents.sparkSession
    records = keep(record_slots(documents, slots), "records")
    sizes = keep(slot_sizes(spark, records, slots), "slot-sizes")
    root = root or scratch_path(spark, "slot-map")
    store_map(deal_slots(sizes, shards), root, 1)
    assigned = read_map(spark, root, 1)
    store_map(grow(sizes, assigned, shards), root, 2)
    rebalanced = read_map(spark, root).withColumnRenamed("shard", "rebalanced_shard")
    portions = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / portion_rows)).alias("portions")
    # One row per slot, and slots are a fixed number: always small enough to broadcast.
    placed = assigned.join(F.broadcast(sizes), "virtual_slot").select("virtual_slot", "shard", portions)
    placed = placed.join(F.broadcast(rebalanced), "virtual_slot")
    dealt = records.join(F.broadcast(placed), "virtual_slot")
    dealt = dealt.withColumn("portion", F.pmod(F.xxhash64("place"), F.col("portions")))
    counted = keep(dealt.groupBy("shard", "virtual_slot", "portion").agg(F.count(F.lit(1)).alias("n")), "portions")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "portion").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "virtual_slot", "portion", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    # Portions are slots and a millionth of the rows: thousands, and 100,000 for 10^11 rows.
    within = Window.partitionBy("virtual_slot", "portion").orderBy("doc_id", "text_crc32", "size", "place")
    numbered = dealt.withColumn("number", F.row_number().over(within))
    joined = numbered.join(F.broadcast(offsets), ["virtual_slot", "portion"])
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("number") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "rebalanced_shard",
    )
