"""Lookups, as-of join and product code resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesales._cols import as_list
from lakesales.functions.text import blank_to_null, code_key, norm_key
from lakesales.session import scratch_path
from lakesales.sources.sinks import write_table


def join_lines(lines: DataFrame, headers: DataFrame, key: str = "DocEntry") -> DataFrame:
    """Lines with their header; orphan lines drop out.

    Left to the planner: both sides grow with the data, and a document with very many lines is
    split by the adaptive skew join.
    """
    return lines.join(headers, key, "inner")


def star_lookup(fact: DataFrame, dim: DataFrame, fact_code: Column, dim_code: str,
                columns: list[str]) -> DataFrame:
    """Left join on a text code, case and end blanks ignored; adds ``columns`` of the dimension.

    Every fact row comes back once: of members whose codes differ in case or end blanks only, the one with the
    smallest ``columns`` counts, and ``validation.code_conflicts`` reports them. No broadcast hint: customer and
    product dimensions grow with the data, and Spark broadcasts by itself what its size estimate allows.
    """
    members = dim.groupBy(norm_key(dim_code).alias("_dim_code"))
    if len(columns) == 1:
        keyed = members.agg(F.min(columns[0]).alias(columns[0]))
    else:
        keyed = members.agg(F.min(F.struct(*columns)).alias("_m")).select(
            "_dim_code", *[F.col(f"_m.{c}").alias(c) for c in columns])
    # rows without a code match nothing; a text of their own keeps them from meeting in one task
    own = F.concat(F.lit("\u0000"), F.xxhash64(*fact.columns).cast("string"))
    coded = fact.withColumn("_fact_code", F.coalesce(norm_key(fact_code), own))
    joined = coded.join(keyed, F.col("_fact_code") == F.col("_dim_code"), "left")
    return joined.select(*fact.columns, *columns)


def fallback_key(dim: DataFrame, code_col: str, code: str, key: str) -> Column:
    """Surrogate key of one code as a scalar subquery, computed once per query."""
    return dim.where(F.col(code_col) == code).select(key).scalar()


def _slice_bounds(points: DataFrame, slices: int) -> list[str]:
    """At most ``slices - 1`` cut points that spread the points evenly over time."""
    if slices <= 1:
        return []
    shares = [i / slices for i in range(1, slices)]
    cuts = F.percentile_approx("_ts", shares, 10 * slices).cast("array<string>")
    return sorted(set(points.select(cuts).first()[0] or []), key=lambda b: (len(b), b))


def _time_slice(ts: str, kind: str, bounds: list[str]) -> Column:
    """Number of boundaries at or below ``ts``, by bisection."""
    if not bounds:
        return F.lit(0)
    cuts = F.array_sort(F.split(F.lit("|".join(bounds)), r"\|").cast(f"array<{kind}>"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(cuts, at + step - 1) <= F.col(ts), at + step).otherwise(at))


def asof_backward(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
                  columns: list[str], by: list[str] | None = None, strict: bool = True,
                  slices: int | None = None,
                  found: str | None = None) -> DataFrame:
    """Adds to every left row the columns of the newest right row before it.

    ``strict`` asks for an earlier time, else an equal one counts too. The newest row counts even
    when its values are NULL. Of right rows with the same key and time the greatest one wins.

    Both sides are first reduced to distinct (key, time) points, so copies cost nothing, and time
    is cut into slices holding equal numbers of points. A slice is filled by a window over
    (key, slice), and the value carried into it comes from a table of one row per (key, slice).
    A key that owns a third of all rows is thus spread over a third of the slices. With more than one slice the
    points are written to the shared folder when this is called.
    """
    by = by or []
    keys = [f"_k{i}" for i in range(len(by))]
    payload = F.struct(*columns)

    def points(df: DataFrame, ts: str) -> list[Column]:
        return [F.col(b).alias(k) for b, k in zip(by, keys)] + [F.col(ts).alias("_ts")]

    known = F.col("_ts").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    values = (right.select(*points(right, right_ts), payload.alias("_v")).where(known)
              .groupBy(*keys, "_ts").agg(F.max("_v").alias("_v")))
    wanted = left.select(*points(left, left_ts)).where(known).distinct()
    value_type = values.schema["_v"].dataType

    right_first = 0 if not strict else 1
    events = (values.withColumn("_side", F.lit(right_first))
              .unionByName(wanted.withColumn("_v", F.lit(None).cast(value_type))
                           .withColumn("_side", F.lit(1 - right_first)))
              .withColumn("_is_left", F.col("_side") == F.lit(1 - right_first)))

    if slices is None:
        slices = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = events.schema["_ts"].dataType.simpleString()
    bounds = []
    if slices > 1:
        # read three times from here on; cut points come from distinct points, so one busy instant moves none
        events = write_table(events, scratch_path(left.sparkSession, "points"))
        bounds = _slice_bounds(events, slices)
    events = events.withColumn("_slice", _time_slice("_ts", kind, bounds))

    inside = (W.partitionBy(*keys, "_slice").orderBy("_ts", "_side")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    filled = events.withColumn("_in", F.last("_v", ignorenulls=True).over(inside))
    hits = filled.where("_is_left").select(*keys, "_ts", "_slice", "_in")

    if bounds:
        order = (W.partitionBy(*keys) if keys else W.partitionBy()).orderBy("_slice")
        carried = (events.groupBy(*keys, "_slice")
                   .agg(F.max_by("_v", F.when(~F.col("_is_left"), F.col("_ts"))).alias("_last"))
                   .withColumn("_carry", F.last("_last", ignorenulls=True).over(
                       order.rowsBetween(W.unboundedPreceding, -1)))
                   .select(*keys, "_slice", "_carry"))
        hits = (hits.join(carried, [*keys, "_slice"], "left")
                .withColumn("_in", F.coalesce("_in", "_carry")))

    hits = hits.select(*[F.col(k).alias(b) for k, b in zip(keys, by)],
                       F.col("_ts").alias(left_ts), F.col("_in").alias("_match"))
    joined = left.join(hits, [*by, left_ts], "left")
    out = [F.col(c) for c in left.columns] + [F.col(f"_match.{c}").alias(c) for c in columns]
    if found:
        out.append(F.col("_match").isNotNull().alias(found))
    return joined.select(*out)


def resolve_sku(df: DataFrame, bridge: DataFrame, dim: DataFrame,
                override: DataFrame | None = None, sku: str = "sku", alt: str = "codigo_alt",
                mongo: str = "codigo_mongo", spread_by: Sequence[str] | None = None) -> DataFrame:
    """Adds SKU_Oficial and resolved_by, tried in order: override, SKU, codigo_alt, codigo_mongo.

    ``bridge`` is (FuenteOrigen, CodigoFuente, SKU_Oficial), ``dim`` has SKU_Oficial and
    ``override`` maps a code as given to an SKU. Lookups run on the distinct code triples, so the
    large side takes part in one join only; it is not sorted, as a task hashes its share of the triples.
    ``spread_by`` are columns that tell rows without any code apart, all when not given; with few of them, columns that
    nobody reads later are not moved.
    """
    codes = df.select(blank_to_null(sku).alias("_sku"), blank_to_null(alt).alias("_alt"),
                      blank_to_null(mongo).alias("_mongo")).distinct()
    official = dim.select(norm_key("SKU_Oficial").alias("_key"), F.col("SKU_Oficial").alias("_by_sku"))

    def codes_of(source: str, out: str) -> DataFrame:
        return bridge.where(F.col("FuenteOrigen") == source).select(
            norm_key("CodigoFuente").alias("_key"), F.col("SKU_Oficial").alias(out))

    def look_up(codes: DataFrame, table: DataFrame, code: str) -> DataFrame:
        return codes.join(table, norm_key(code) == F.col("_key"), "left").drop("_key")

    codes = look_up(codes, official, "_sku")
    codes = look_up(codes, codes_of("MySQL", "_by_alt"), "_alt")
    codes = look_up(codes, codes_of("MongoDB", "_by_mongo"), "_mongo")
    hits = [("SKU", "_by_sku"), ("codigo_alt", "_by_alt"), ("codigo_mongo", "_by_mongo")]
    if override is not None:
        given = override.select(norm_key("codigo").alias("_key"), F.col("SKU_Oficial").alias("_given"))
        codes = codes.withColumn("_any", F.coalesce("_sku", "_alt", "_mongo"))
        codes = look_up(codes, given, "_any")
        hits.insert(0, ("override", "_given"))
    resolved_by = F.coalesce(*[F.when(F.col(c).isNotNull(), name) for name, c in hits])
    codes = codes.select(F.col("_sku").alias("_s"), F.col("_alt").alias("_a"),
                         F.col("_mongo").alias("_m"),
                         F.coalesce(*[F.col(c) for _, c in hits]).alias("SKU_Oficial"),
                         resolved_by.alias("resolved_by"))
    given = [code_key(c) for c in (sku, alt, mongo)]
    same = F.lit(True)
    for code, found in zip(given, ("_s", "_a", "_m")):
        same = same & code.eqNullSafe(F.col(found))
    # rows without any code may be many and all share one key: a key of their own spreads them over the tasks
    codeless = F.coalesce(*given).isNull()
    salt = F.when(codeless, F.xxhash64(*(spread_by or df.columns))).otherwise(0)
    salted = df.withColumn("_salt", salt)
    found = salted.join(codes.withColumn("_none", F.lit(0).cast("bigint")).hint("shuffle_hash"), same & (F.col("_salt") == F.col("_none")), "left")
    return found.drop("_s", "_a", "_m", "_salt", "_none")


def name_key(name: str, category: str) -> list[Column]:
    return [norm_key(F.regexp_replace(F.trim(name), r"\s+", " ")),
            norm_key(F.regexp_replace(F.trim(category), r"\s+", " "))]


def match_by_name(df: DataFrame, dim: DataFrame, name: str = "nombre",
                  category: str = "categoria") -> DataFrame:
    """Adds SKU_Oficial by unique (name, category), or the reason why there is none."""
    name_k, cat_k = name_key("Nombre", "Categoria")
    table = (dim.groupBy(name_k.alias("_n"), cat_k.alias("_c"))
             .agg(F.count("*").alias("_count"), F.min("SKU_Oficial").alias("_only")))
    df_n, df_c = name_key(name, category)
    joined = df.join(table, (df_n == F.col("_n")) & (df_c == F.col("_c")), "left")
    sku = F.when(F.col("_count") == 1, F.col("_only"))
    why = (F.when(F.col("_count").isNull(), "no match")
           .when(F.col("_count") > 1, "ambiguous"))
    return joined.select(*df.columns, sku.alias("SKU_Oficial"), why.alias("motivo"))


def orphans(df: DataFrame, ref: DataFrame, key: str | list[str],
            ref_key: str | list[str]) -> DataFrame:
    """Rows whose key is set but unknown to ``ref``."""
    cols, refs = as_list(key), as_list(ref_key)
    keys = ref.select(*[F.col(r).alias(f"_r{i}") for i, r in enumerate(refs)])
    same = F.lit(True)
    known = F.lit(True)
    for i, c in enumerate(cols):
        same = same & (F.col(c) == F.col(f"_r{i}"))
        known = known & F.col(c).isNotNull()
    return df.where(known).join(keys, same, "left_anti")
