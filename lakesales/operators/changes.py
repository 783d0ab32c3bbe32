"""Batch inserts, patches, deletes and dimension upserts as snapshot rebuilds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesales.functions.dates import add_years
from lakesales.functions.nested import order_total
from lakesales.operators.keys import assign_keys
from lakesales.session import scratch_path
from lakesales.sources.sinks import rewrite_partitions, write_table

PROTECTED = ("creado",)
#: Buckets of keys that snapshots are compared by: the list of those that differ is sent to every task.
BUCKETS = 1 << 16


def apply_inserts(df: DataFrame, new: DataFrame, run_ts: Column) -> DataFrame:
    """New rows with both time stamps set and, for orders, the total computed from the items."""
    stamped = new.withColumns({c: run_ts for c in ("creado", "actualizado") if c in df.columns})
    if "items" in df.columns and "total" in df.columns:
        kind = df.schema["total"].dataType
        stamped = stamped.withColumn("total", order_total("items").cast(kind))
    return df.unionByName(stamped.select(*[c for c in df.columns if c in stamped.columns]),
                          allowMissingColumns=True)


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``; combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return newest.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def one_per_key(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order``, or an error where a key has two rows and nothing orders them."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    best = F.max_by(row, F.col(order)) if order else F.any_value(row)
    kept = df.groupBy(*keys).agg(best.alias("_r"), F.count("*").alias("_n"))
    if not order:
        many = F.raise_error(F.concat(F.lit("several rows for one key: "), F.concat_ws(
            "|", *[F.col(k).cast("string") for k in keys])))
        kept = kept.withColumn("_r", F.when(F.col("_n") == 1, F.col("_r")).otherwise(many))
    return kept.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def _patched(df: DataFrame, patches: DataFrame, key: str, supplied: str, order: str | None) -> DataFrame:
    patches = one_per_key(patches, [key], order)
    fields = [c for c in patches.columns if c in df.columns and c != key and c not in PROTECTED]
    incoming = patches.select(F.col(key), F.lit(True).alias("_hit"),
                              *([F.col(supplied).alias("_set")] if supplied in patches.columns else []),
                              *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = df.join(incoming, key, "left")
    given = {c: (F.array_contains("_set", c) if supplied in patches.columns
                 else F.col(f"_new_{c}").isNotNull()) for c in fields}
    values = {c: F.when(F.coalesce(given[c], F.lit(False)), F.col(f"_new_{c}")).otherwise(F.col(c))
              for c in fields}
    if "items" in fields and "total" in df.columns:
        kind = df.schema["total"].dataType
        old = values.get("total", F.col("total"))
        values["total"] = F.when(F.coalesce(given["items"], F.lit(False)),
                                 order_total("_new_items").cast(kind)).otherwise(old)
    changed = F.lit(False)
    for c, v in values.items():
        changed = changed | ~v.eqNullSafe(F.col(c))
    return joined.select(
        *[values[c].alias(c) if c in values else F.col(c) for c in df.columns],
        F.coalesce("_hit", F.lit(False)).alias("_hit"),
        (F.coalesce("_hit", F.lit(False)) & changed).alias("_changed"))


def apply_patches(df: DataFrame, patches: DataFrame, key: str, run_ts: Column,
                  supplied: str = "supplied", order: str | None = None) -> DataFrame:
    """Overwrites supplied fields only, keeps ``creado``, sets ``actualizado`` on patched rows.

    ``supplied`` is an array column naming the fields a patch sets, which lets it set NULL;
    without it the non-NULL fields count as supplied. New items recompute the total. Of several patches of a key
    the last by the column ``order`` counts; without such a column they are an error.
    """
    out = _patched(df, patches, key, supplied, order)
    if "actualizado" in df.columns:
        out = out.withColumn("actualizado", F.when(F.col("_hit"), run_ts).otherwise(F.col("actualizado")))
    return out.select(*df.columns)


def patch_table(spark: SparkSession, path: str, partition_by: Sequence[str], patches: DataFrame, key: str,
                run_ts: Column, supplied: str = "supplied", order: str | None = None) -> DataFrame:
    """``apply_patches`` on a stored table: returns the partitions that were rewritten.

    The patched keys are located first, by key and partition columns alone. Only partitions that hold one are read
    whole and written anew; the files of all others stay. A patch may not set a partition column, since the row would
    have to move.
    """
    moved = [c for c in partition_by if c in patches.columns and c != key]
    if moved:
        raise ValueError(f"a patch cannot move rows to another partition: {', '.join(moved)}")

    def located(stored: DataFrame) -> DataFrame:
        return stored.select(key, *partition_by).join(patches.select(key).distinct(), key, "left_semi")

    return rewrite_partitions(spark, path, partition_by, located,
                              lambda held: apply_patches(held, patches, key, run_ts, supplied, order))


def apply_deletes(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Remaining rows, and every requested id with whether it was found."""
    wanted = ids.select(key).distinct()
    present = df.select(key, F.lit(True).alias("_there")).distinct()
    report = wanted.join(present, key, "left").select(
        key, F.coalesce("_there", F.lit(False)).alias("eliminado"))
    return df.join(wanted, key, "left_anti"), report


def change_report(df: DataFrame, patches: DataFrame, key: str,
                  supplied: str = "supplied", order: str | None = None) -> DataFrame:
    """Every patch key with its outcome: modified, unchanged or not found."""
    hit = _patched(df, patches, key, supplied, order).where("_hit").select(key, "_changed")
    state = (F.when(F.col("_changed").isNull(), "not found")
             .when(F.col("_changed"), "modified").otherwise("unchanged"))
    return patches.select(key).distinct().join(hit, key, "left").select(key, state.alias("estado"))


def _digests(df: DataFrame, key: str, cols: Sequence[str], buckets: int) -> DataFrame:
    """One row a bucket of keys: how many rows, and two sums of row hashes, whatever the order of the rows."""
    simple, flags = [], []
    for c in [key, *cols]:
        nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))
        # a hash skips what is NULL: where a value is missing is hashed beside the values, inside nested ones as text
        simple.append(F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else F.col(c))
        flags.append(F.col(c).isNull())
    wide = "decimal(38,0)"
    return df.where(F.col(key).isNotNull()).groupBy(_bucket(key, buckets).alias("_bucket")).agg(
        F.count("*").alias("_n"), F.sum(F.xxhash64(*flags, *simple).cast(wide)).alias("_s"),
        F.sum(F.xxhash64(F.lit("second"), *simple, *flags).cast(wide)).alias("_t"))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def changed_buckets(before: DataFrame, after: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The buckets of keys whose rows are not the same in both snapshots: ``buckets`` rows at most."""
    cols = [c for c in before.columns if c in after.columns and c != key]
    a = _digests(before, key, cols, buckets)
    b = _digests(after, key, cols, buckets).select("_bucket", *[F.col(c).alias(f"{c}2") for c in ("_n", "_s", "_t")])
    same = F.col("_n").eqNullSafe(F.col("_n2")) & F.col("_s").eqNullSafe(F.col("_s2")) & F.col("_t").eqNullSafe(F.col("_t2"))
    return a.join(b, "_bucket", "full").where(~same).select("_bucket")


def compare_snapshots(before: DataFrame, after: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Every key of two snapshots with inserted, modified, deleted or unchanged.

    Both sides are first reduced to a digest for each bucket of keys. Only rows in buckets that differ are compared one
    by one, so what is shuffled follows the changes and not the tables; keys of the others come back unchanged from
    where they are. Rows without a key match nothing.
    """
    cols = [c for c in before.columns if c in after.columns and c != key]
    differ = write_table(changed_buckets(before, after, key, buckets), scratch_path(before.sparkSession, "buckets"))
    differ = differ.withColumn("_differs", F.lit(True))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", _bucket(key, buckets)).join(F.broadcast(differ), "_bucket", "left")

    to_compare = F.col("_differs") | F.col(key).isNull()
    unchanged = marked(before.select(key)).where(~F.coalesce(to_compare, F.lit(False))).select(
        key, F.lit("unchanged").alias("estado"))
    a = marked(before).where(to_compare).select(F.col(key), F.struct(*cols).alias("_a"), F.lit(1).alias("_in_a"))
    b = marked(after).where(to_compare).select(F.col(key), F.struct(*cols).alias("_b"), F.lit(1).alias("_in_b"))
    state = (F.when(F.col("_in_a").isNull(), "inserted").when(F.col("_in_b").isNull(), "deleted")
             .when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged").otherwise("modified"))
    return a.join(b, key, "full").select(key, state.alias("estado")).unionByName(unchanged)


def shift_years(df: DataFrame, cols: Sequence[str], years: int) -> DataFrame:
    return df.withColumns({c: add_years(c, years) for c in cols})


def upsert_dim(existing: DataFrame, incoming: DataFrame, natural: list[str], surrogate: str,
               run_ts: Column, order: str | None = None, top: Column | None = None) -> DataFrame:
    """Type-1 upsert: known members keep their key and creation time, new ones get the next keys.

    Of several incoming rows of a member the last by ``order`` counts; without it they are an error. ``top`` is the
    greatest key in use, where ``existing`` is not the whole dimension.
    """
    incoming = one_per_key(incoming, natural, order)
    attributes = [c for c in existing.columns
                  if c not in (*natural, surrogate, "FechaCreacion", "FechaActualizacion")]
    new = incoming.select(*natural, *[F.col(c).alias(f"_new_{c}") for c in attributes],
                          F.lit(True).alias("_in"))
    both = existing.join(new, natural, "left")
    changed = F.lit(False)
    for c in attributes:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    touched = F.coalesce("_in", F.lit(False)) & changed
    kept = both.select(
        surrogate, *natural,
        *[F.when(touched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in attributes],
        "FechaCreacion",
        F.when(touched, run_ts).otherwise(F.col("FechaActualizacion")).alias("FechaActualizacion"))
    if top is None:
        top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).scalar()
    added = assign_keys(incoming.join(existing.select(*natural), natural, "left_anti")
                        .select(*natural, *attributes), natural, surrogate, start=top + 1)
    added = added.withColumn("FechaCreacion", run_ts).withColumn("FechaActualizacion", run_ts)
    return kept.unionByName(added.select(*kept.columns))


def dim_buckets(df: DataFrame, natural: Sequence[str], buckets: int) -> DataFrame:
    """Adds ``cubeta``, the partition of a member in a stored dimension."""
    return df.withColumn("cubeta", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in natural]), F.lit(buckets)).cast("int"))


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, natural: list[str], surrogate: str, run_ts: Column,
                 buckets: int, order: str | None = None) -> DataFrame:
    """``upsert_dim`` on a dimension stored by ``dim_buckets``: returns the buckets that were rewritten.

    A member's bucket follows from its natural key, so only buckets of incoming members are read and written; of the
    others nothing but the greatest key is asked.
    """
    incoming = write_table(dim_buckets(incoming, natural, buckets), scratch_path(spark, "incoming"))

    def upserted(held: DataFrame) -> DataFrame:
        top = spark.read.parquet(path).agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).scalar()
        out = upsert_dim(held.drop("cubeta"), incoming.drop("cubeta"), natural, surrogate, run_ts, order, top)
        return dim_buckets(out, natural, buckets)

    return rewrite_partitions(spark, path, ["cubeta"], lambda _: incoming.select("cubeta"), upserted)
