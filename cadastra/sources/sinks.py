"""Sinks: tables, scoped rewrites, SQL statements in batches, deltas against a manifest, GeoJSON and KML exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.text import sql_literal, xml_escape
from cadastra.operators.edits import row_signature

MAX_ROWS, MAX_BYTES = 500, 50_000
NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_scoped(df: DataFrame, path: str, scope: str) -> None:
    """Replace the scopes that df holds and leave the files of all others untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def value_tuples(df: DataFrame) -> Column:
    kinds = dict(df.dtypes)
    parts = [sql_literal(F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c), kinds[c] not in NUMERIC) for c in df.columns]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


#: Rows that one task batches at a time.
LANE_ROWS = 50_000


def insert_statements(df: DataFrame, table: str, order: str, lanes: int | None = None, verb: str = "INSERT") -> DataFrame:
    """(lane, statement_no, statement): multi-row inserts of at most MAX_ROWS rows and MAX_BYTES bytes each.

    A batch starts anew where a row does not fit, which is sequential; rows are dealt over lanes first, so batching runs
    in parallel and no lane needs the others. Without a number of lanes, one holds about LANE_ROWS rows at any size.
    """
    lanes = max(1, -(-df.count() // LANE_ROWS)) if lanes is None else lanes
    head = f"{verb} INTO {table} ({','.join(df.columns)}) VALUES "
    rows = df.select(F.pmod(F.xxhash64(order), F.lit(lanes)).alias("lane"), F.col(order).alias("__k"), value_tuples(df).alias("v"))

    def pack(key, pdf):
        import pandas as pd

        out, batch, size = [], [], len(head)
        for v in pdf.sort_values("__k")["v"]:
            n = len(v.encode()) + 1
            if batch and (len(batch) == MAX_ROWS or size + n > MAX_BYTES):
                out.append(head + ",".join(batch) + ";")
                batch, size = [], len(head)
            batch.append(v)
            size += n
        if batch:
            out.append(head + ",".join(batch) + ";")
        return pd.DataFrame({"lane": key[0], "statement_no": range(len(out)), "statement": out})

    return rows.groupBy("lane").applyInPandas(pack, "lane long, statement_no long, statement string")


def delete_statements(keys: DataFrame, table: str, key: str) -> DataFrame:
    return keys.select(F.concat(F.lit(f"DELETE FROM {table} WHERE {key}="), sql_literal(F.col(key), dict(keys.dtypes)[key] not in NUMERIC), F.lit(";")).alias("statement"))


def ordered_dump(parts: list[tuple[int, int, DataFrame]]) -> DataFrame:
    """(phase, rank, statement) of deletes (child tables first) and inserts (parents first), to be ordered by both."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(p).alias("phase"), F.lit(r).alias("rank"), "statement") for p, r, df in parts])


def delta_with_manifest(new: DataFrame, manifest: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(changes(key, action), pending manifest(key, sig)). Promote the pending one only after the changes are applied:
    until then a rerun gives the same changes again, after it none."""
    sig = new.select(F.col(key).cast("string").alias("key"), row_signature(new, new.columns).alias("sig"))
    met = sig.join(manifest.withColumnRenamed("sig", "old"), "key", "full_outer")
    action = F.when(F.col("sig").isNull(), "D").when(F.col("old").isNull() | (F.col("sig") != F.col("old")), "U")
    return met.select("key", action.alias("action")).where("action IS NOT NULL"), sig


def changed_blobs(blobs: DataFrame, manifest: DataFrame) -> DataFrame:
    """blobs(key, blob) whose content the manifest(key, sig) does not hold yet."""
    hashed = blobs.withColumn("sig", F.sha2("blob", 256))
    return hashed.join(manifest, ["key", "sig"], "left_anti")


def feature_collection(df: DataFrame, group: list[str], geometry: str, properties: list[str], order: str) -> DataFrame:
    """(group..., geojson): a FeatureCollection per group, features in order; geometry is a JSON text column."""
    props = F.to_json(F.struct(*properties))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.col(geometry), F.lit("}"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), feature.alias("f")))), lambda x: x["f"]), ",")
    return df.groupBy(*group).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), listed, F.lit("]}")).alias("geojson"))


def ring_geojson(ring: Column) -> Column:
    """Polygon geometry of a ring (array<struct<x,y>>, x and y already geographic), closed."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.array_join(F.transform(closed, lambda v: F.format_string("[%s,%s]", v["x"], v["y"])), ","), F.lit("]]}"))


def kml(df: DataFrame, group: list[str], name: str, description: str, rings: str, order: str) -> DataFrame:
    """(group..., kml): a document per group, a placemark per row; rings is array<array<struct<x,y>>>, outer rings first."""
    line = lambda r: F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), lambda v: F.format_string("%s,%s,0", v["x"], v["y"])), " ")
    polygon = lambda r: F.concat(F.lit("<Polygon><outerBoundaryIs><LinearRing><coordinates>"), line(r), F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon>"))
    mark = F.concat(
        F.lit("<Placemark><name>"), xml_escape(F.col(name).cast("string")), F.lit("</name><description>"), xml_escape(F.col(description).cast("string")),
        F.lit("</description><MultiGeometry>"), F.array_join(F.transform(rings, polygon), ""), F.lit("</MultiGeometry></Placemark>"),
    )
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), mark.alias("m")))), lambda x: x["m"]), "")
    head = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
    return df.groupBy(*group).agg(F.concat(F.lit(head), listed, F.lit("</Document></kml>")).alias("kml"))


def split_statements(lines: DataFrame, marker: str = "-- CHUNK") -> DataFrame:
    """lines(scope, line_no, line) -> (scope, chunk, line_no, line) with a new chunk at each marker line."""
    w = Window.partitionBy("scope").orderBy("line_no")
    return lines.withColumn("chunk", F.sum(F.col("line").startswith(marker).cast("int")).over(w))


def update_statements(df: DataFrame, table: str, key: str, columns: list[str]) -> DataFrame:
    """(key, statement): one UPDATE of some columns a row, for tables whose rows others point to and that cannot be reloaded."""
    sets = [F.concat(F.lit(f"{c}="), sql_literal(F.col(c), dict(df.dtypes)[c] == "string")) for c in columns]
    where = F.concat(F.lit(f" WHERE {key}="), sql_literal(F.col(key), dict(df.dtypes)[key] == "string"), F.lit(";"))
    return df.select(key, F.concat(F.lit(f"UPDATE {table} SET "), F.concat_ws(", ", *sets), where).alias("statement"))
