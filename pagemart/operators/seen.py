"""Keys of earlier runs, stored so that a new run reads only the part of them it may need.

Each run adds its keys as files by bucket, a bucket of the key's hash, and beside them a filter: words of 64 bits, a row each,
in which a key sets four bits of one word. A later run joins its keys to the words, which are a small part of the keys, and reads
the buckets alone that hold a key whose bits are all set. A filter never rules out a key that is stored, so the answer is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.session import delete_path, discard, exists, materialise, names_in

#: Keys a word is meant for: 16 bits a key, of which at most four are set.
KEYS_A_WORD = 4


def _mask(key: Column) -> Column:
    """Four bits of a 64-bit word."""
    sign = F.xxhash64(key, F.lit(2))
    places = [F.shiftright(sign, 6 * i).bitwiseAND(63).cast("int") for i in range(4)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


class SeenKeys:
    """A store of text keys under ``path``. ``buckets`` must stay the same for a store."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def runs(self) -> list[str]:
        """The runs that are whole: their filter is written last."""
        names = [name[4:] for name in names_in(self.spark, f"{self.path}/words") if name.startswith("run=")]
        return [run for run in names if exists(self.spark, f"{self.path}/words/run={run}/_SUCCESS")]

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame, key: str, run: str) -> None:
        """Store the distinct keys of a run; NULL is no key. A run added again replaces itself, so it can be repeated after a loss."""
        for part in ("words", "keys"):  # without its filter the run is not read
            delete_path(self.spark, f"{self.path}/{part}/run={run}")
        keys = rows.select(F.col(key).cast("string").alias("key")).where("key IS NOT NULL").distinct()
        keys = keys.withColumn("bucket", self._bucket(F.col("key"))).repartition("bucket")
        keys.write.partitionBy("bucket").parquet(f"{self.path}/keys/run={run}")
        stored = self._stored().where(F.col("run") == run)
        words = max(1, -(-stored.count() // (self.buckets * KEYS_A_WORD)))
        place = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(words)).alias("word")
        filled = stored.select("bucket", place, _mask(F.col("key")).alias("bits")).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        filled.withColumn("words", F.lit(words).cast("bigint")).write.parquet(f"{self.path}/words/run={run}")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema("key string, run string, bucket int").parquet(f"{self.path}/keys")

    def _possible(self, rows: DataFrame, key: str) -> DataFrame | None:
        """(run, bucket, key) that the filters cannot rule out, written; None if nothing is stored."""
        if not self.runs():
            return None
        words = self.spark.read.schema("bucket int, word bigint, bits bigint, words bigint, run string").parquet(f"{self.path}/words")
        words = words.where(F.col("run").isin(self.runs()))
        sizes = words.groupBy("run").agg(F.first("words").alias("words"))  # a row for each run
        listed = sizes.agg(F.collect_list(F.struct("run", "words"))).first()[0]
        if not listed:
            return None
        runs = F.array(*[F.struct(F.lit(r.run).alias("run"), F.lit(r.words).cast("bigint").alias("words")) for r in listed])
        asked = rows.select(F.col(key).cast("string").alias("key")).where("key IS NOT NULL").distinct()
        asked = asked.select("key", self._bucket(F.col("key")).alias("bucket"), _mask(F.col("key")).alias("mask"), F.explode(runs).alias("r"))
        asked = asked.select("key", "bucket", "mask", "r.run", F.pmod(F.xxhash64("key", F.lit(1)), "r.words").alias("word"))
        met = asked.join(words.select("run", "bucket", "word", "bits"), ["run", "bucket", "word"])
        return materialise(met.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("run", "bucket", "key"), "possible")

    def _read(self, possible: DataFrame) -> DataFrame:
        """The stored keys of the buckets that ``possible`` names; at most a row for each run and bucket comes to the driver."""
        needed: dict[str, list[int]] = {}
        for r in possible.select("run", "bucket").distinct().collect():
            needed.setdefault(r.run, []).append(r.bucket)
        wanted = F.lit(False)
        for run, buckets in needed.items():
            wanted = wanted | ((F.col("run") == run) & F.col("bucket").isin(buckets))
        return self._stored().where(wanted)

    def unseen(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key no earlier run has; rows without a key stay."""
        possible = self._possible(rows, key)
        if possible is None:
            return rows
        met = possible.join(self._read(possible), ["run", "bucket", "key"]).select("key").distinct()
        met = materialise(met, "met")
        discard(possible)
        return rows.join(met, F.col(key).cast("string") == F.col("key"), "left_anti")

    def compact(self, run: str) -> None:
        """Make one run of all, under a new name, so that a key is looked up in one filter."""
        former = self.runs()
        if run in former:
            raise ValueError(f"there is a run {run}")
        self.add(self._stored().where(F.col("run").isin(former)), "key", run)
        for old in former:
            for part in ("words", "keys"):
                delete_path(self.spark, f"{self.path}/{part}/run={old}")
