"""Schema check: strict verdict per source plus a field-by-field diff.

The verdict is ``StructType`` equality (order-, case-, type-, nullability-
and metadata-sensitive), the same test the data lake gate has always used.
The diff explains a ``no_match``: one row per column that is expected or
present, with its status. Both are computed on the driver from a frame's
schema (metadata, no data read, no Spark job); the report of all sources
is one small frame, written once, so no source's report overwrites another.
A load's files need not share that schema: ``file_schema_report`` compares the
footer of each, on the executors.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import glob_escaped, ship_package
from ..sources.lake import data_files, write_leaf
from ..sources.local import local_frame

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def fields(*pairs) -> T.StructType:
    """Struct of nullable fields from (name, type) pairs."""
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


def strings(*names) -> T.StructType:
    return fields(*[(n, STRING) for n in names])


# --- fixed values: expected schemas per (source, layer) --------------------------
EXPECTED_SCHEMAS: dict[tuple[str, str], T.StructType] = {
    ("google_play", "bronze"): fields(
        ("avatar", STRING), ("date", STRING), ("id", STRING), ("iso_date", STRING), ("likes", LONG), ("rating", DOUBLE),
        ("response", T.MapType(STRING, STRING, True)), ("snippet", STRING), ("title", STRING)),
    ("mongodb", "bronze"): fields(
        ("id", STRING), ("comment", STRING), ("votes_count", INT), ("os", STRING), ("os_version", STRING),
        ("country", STRING), ("age", INT), ("customer_id", STRING), ("cpf", STRING), ("app_version", STRING),
        ("rating", INT), ("timestamp", STRING), ("app", STRING)),
    ("apple_store", "bronze"): strings(
        "author_name", "author_uri", "content", "content_attributes_label",
        "content_attributes_term", "id", "im_rating", "im_version", "im_votecount",
        "im_votesum", "link_attributes_href", "link_attributes_related", "title", "updated"),
    ("google_play", "silver"): fields(
        ("id", STRING), ("app", STRING), ("segmento", STRING), ("rating", STRING), ("iso_date", STRING), ("title", STRING),
        ("snippet", STRING),
        ("historical_data", T.ArrayType(strings(
            "title", "snippet", "app", "segmento", "rating", "iso_date"), True))),
    ("mongodb", "silver"): fields(
        ("id", STRING), ("customer_id", STRING), ("cpf", STRING), ("app", STRING), ("segmento", STRING), ("rating", STRING),
        ("timestamp", STRING), ("comment", STRING), ("app_version", STRING), ("os_version", STRING), ("os", STRING),
        ("historical_data", T.ArrayType(strings(
            "customer_id", "cpf", "app", "comment", "segmento", "rating", "timestamp",
            "app_version", "os_version", "os"), True))),
    ("apple_store", "silver"): fields(
        ("id", STRING), ("name_client", STRING), ("app", STRING), ("im_version", STRING), ("im_rating", STRING),
        ("title", STRING), ("content", STRING), ("updated", STRING), ("segmento", STRING),
        ("historical_data", T.ArrayType(strings(
            "title", "content", "app", "segmento", "im_version", "im_rating"), True))),
}
LAYERS = ("bronze", "silver")

MATCH, NO_MATCH, MISSING_SOURCE = "match", "no_match", "missing_source"

REPORT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("validation_status", T.StringType()),
    T.StructField("expected_schema", T.StringType()),
    T.StructField("current_schema", T.StringType()),
    T.StructField("differences", T.StringType()),
])
# --- end fixed values -----------------------------------------------------------

_DIFF_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("expected_position", T.IntegerType()),
    T.StructField("actual_position", T.IntegerType()),
    T.StructField("expected_type", T.StringType()),
    T.StructField("actual_type", T.StringType()),
    T.StructField("status", T.StringType()),
])


def expected_schema(source: str, layer: str) -> T.StructType:
    """Expected schema of ``source`` in ``layer``; unknown pair -> ValueError."""
    key = (source, layer)
    if key not in EXPECTED_SCHEMAS:
        raise ValueError(f"no expected schema is registered for {source!r} in layer {layer!r}")
    return EXPECTED_SCHEMAS[key]


def _as_schema(x) -> T.StructType | None:
    if x is None or isinstance(x, T.StructType):
        return x
    return x.schema


def _field_map(schema: T.StructType | None) -> dict[str, tuple[int, T.StructField]]:
    return {} if schema is None else {f.name: (i + 1, f) for i, f in enumerate(schema.fields)}


def _out_of_order(expected: T.StructType, actual: T.StructType) -> set[str]:
    """Common fields that do not keep their place among the common fields: a
    column added in front of others moves none of them."""
    there, wanted = set(actual.names), set(expected.names)
    before, after = [n for n in expected.names if n in there], [n for n in actual.names if n in wanted]
    return {n for n, m in zip(before, after) if n != m}


def _status(e, a, moved: bool) -> str:
    if a is None:
        return "missing"
    if e is None:
        return "unexpected"
    (_, ef), (_, af) = e, a
    if ef.dataType.simpleString() != af.dataType.simpleString():
        return "type_mismatch"
    if moved:
        return "moved"
    if ef != af:
        return "nullability_mismatch"
    return "match"


def schema_diff_rows(source: str, layer: str, actual: T.StructType | None,
                     expected: T.StructType) -> list[tuple]:
    """Field-by-field comparison of two schemas (metadata only, no job).

    Fields are matched on exact, case-sensitive name; expected fields come
    first in expected order, then unexpected ones in actual order.
    """
    emap, amap = _field_map(expected), _field_map(actual)
    names = list(emap) + [n for n in amap if n not in emap]
    moved = _out_of_order(expected, actual) if actual is not None else set()
    rows = []
    for n in names:
        e, a = emap.get(n), amap.get(n)
        rows.append((source, layer, n,
                     e[0] if e else None, a[0] if a else None,
                     e[1].dataType.simpleString() if e else None,
                     a[1].dataType.simpleString() if a else None,
                     _status(e, a, n in moved)))
    return rows


def schema_report(spark: SparkSession, actual: Mapping[str, object],
                  expected: Mapping[str, T.StructType], layer: str,
                  drift: Mapping[str, list[tuple]] | None = None) -> DataFrame:
    """One row per source: ``source, layer, validation_status, expected_schema,
    current_schema, differences`` (schemas as JSON; ``differences`` is a JSON
    list of the fields that do not match). ``actual`` maps source ->
    DataFrame or StructType (``None`` = source missing). ``drift`` maps source ->
    differences found over all its files (column_name, expected_position,
    actual_position, expected_type, actual_type, status): a source with any does
    not match, and these are its differences."""
    rows = []
    for source, exp in expected.items():
        cur = _as_schema(actual.get(source))
        if cur is None:
            status = MISSING_SOURCE
        else:
            status = MATCH if cur == exp and not (drift or {}).get(source) else NO_MATCH
        found = [r[2:] for r in schema_diff_rows(source, layer, cur, exp) if r[-1] != MATCH]
        diffs = [dict(zip(_DIFF_SCHEMA.names[2:], r)) for r in ((drift or {}).get(source) or found)]
        rows.append((source, layer, status, exp.json(), cur.json() if cur is not None else None,
                     json.dumps(diffs)))
    return local_frame(spark, rows, REPORT_SCHEMA)


def schema_diff(spark: SparkSession, actual: Mapping[str, object],
                expected: Mapping[str, T.StructType], layer: str) -> DataFrame:
    """Field-by-field comparison, matched on exact (case-sensitive) name.

    status: ``missing`` (expected, absent), ``unexpected`` (present, not
    expected), ``type_mismatch``, ``moved`` (same type, other place among the
    columns that both schemas have),
    ``nullability_mismatch`` (same type string, differing nullability or
    metadata), ``match``. Columns: source, layer, column_name,
    expected_position, actual_position, expected_type, actual_type, status.
    Schemas are metadata, so the comparison runs on the driver and the rows
    (at most sources x columns) become a frame in one Arrow batch.
    """
    rows = []
    for source, exp in expected.items():
        rows += schema_diff_rows(source, layer, _as_schema(actual.get(source)), exp)
    return local_frame(spark, rows, _DIFF_SCHEMA)


# ---- per file ---------------------------------------------------------------

_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"
_FILE_REPORT = ("source string, folder string, file string, validation_status string, error string, n_rows long, "
                "schema_json string, differences array<struct<column_name:string,status:string,expected_type:string,actual_type:string>>")


def _nullable(dt: T.DataType) -> T.DataType:
    """The type as Spark reads it from Parquet: everything may be null."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_nullable(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(_nullable(dt.keyType), _nullable(dt.valueType), True)
    return dt


def _footer(uri: str) -> tuple[T.StructType, int]:
    """Schema in a file's footer, with the folders below ``odate=`` that a read
    would add as partition columns, and its number of rows."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    local = re.fullmatch(r"file:/*(/.*)", uri)
    store, path = fs.FileSystem.from_uri(unquote(local[1]) if local else uri.replace("s3a://", "s3://", 1))
    with store.open_input_file(path) as f:
        footer = pq.read_metadata(f)
    schema = footer.schema.to_arrow_schema()
    own = (schema.metadata or {}).get(_ROW_METADATA)
    found = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(schema, prefer_timestamp_ntz=True)
    below = re.search(r"/odate=[^/]+((?:/[^/]+=[^/]*)*)/[^/]+$", uri)
    parts = [p.split("=", 1) for p in below[1].split("/") if p] if below else []
    return _nullable(T.StructType([*found.fields, *(
        T.StructField(k, INT if re.fullmatch(r"[0-9]{1,9}", v) else STRING) for k, v in parts)])), footer.num_rows


def _folder(uri: str) -> str:
    above = re.search(r"/([^/]+)/odate=[^/]+/", uri)
    return above[1] if above else uri.rsplit("/", 2)[-2]


def file_schema_report(spark: SparkSession, source: str, path: str, expected: T.StructType) -> DataFrame:
    """One row per data file under ``path`` (which may be a glob): its folder
    (the one above ``odate=``), the strict verdict on its own footer and what
    differs. Footers are read by the executors, where the files are listed too;
    an unreadable one is a ``no_match`` with its error."""
    return footer_report(data_files(spark, path), source, expected)


def footer_report(files: DataFrame, source: str, expected: T.StructType | None) -> DataFrame:
    """``file_schema_report`` of the paths in column ``file``. Without an expected
    schema nothing is compared, only read."""
    ship_package(files.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column("file").to_pylist():
                row = {"source": source, "folder": _folder(uri), "file": uri, "error": None, "n_rows": None,
                       "schema_json": None, "differences": []}
                try:
                    actual, row["n_rows"] = _footer(uri)
                    row["validation_status"] = MATCH if actual == expected else NO_MATCH
                    if actual != expected:
                        row["schema_json"] = actual.json()
                    if expected is not None:
                        row["differences"] = [
                            {"column_name": r[2], "status": r[7], "expected_type": r[5], "actual_type": r[6]}
                            for r in schema_diff_rows(source, "", actual, expected) if r[7] != MATCH]
                except Exception as exc:  # noqa: BLE001 - reported as the file's verdict
                    row |= {"validation_status": NO_MATCH, "error": str(exc) or repr(exc)}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_FILE_ARROW)

    return files.mapInArrow(compare, _FILE_REPORT)


_FILE_ARROW = pa.schema([
    ("source", pa.string()), ("folder", pa.string()), ("file", pa.string()), ("validation_status", pa.string()),
    ("error", pa.string()), ("n_rows", pa.int64()), ("schema_json", pa.string()), ("differences", pa.list_(pa.struct([(n, pa.string()) for n in (
        "column_name", "status", "expected_type", "actual_type")])))])


@dataclass(frozen=True)
class LoadFiles:
    """What the footers of a load say, and where the row of each file is."""

    path: str
    n_files: int
    n_rows: int  # of the files that can be read
    n_unreadable: int
    n_differing: int
    n_below: int  # files in folders below the leaf, which a read may treat in its own way

    @property
    def exact(self) -> bool:
        """Whether n_rows is what a read of the load gives."""
        return not self.n_unreadable and not self.n_below

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_FILE_REPORT).parquet(glob_escaped(self.path))


def survey_files(spark: SparkSession, source: str, path: str, expected: T.StructType | None, out: str) -> LoadFiles:
    """Reads every footer of a load once: ``file_schema_report``, written to
    ``out``, with its totals counted by the same job (in its last stage, so that a
    lost task does not count twice)."""
    seen = Observation()
    below = F.col("file").rlike(r"/odate=[^/]+/[^/]+/")
    write_leaf(file_schema_report(spark, source, path, expected).observe(
        seen, F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("rows"), F.count("error").alias("unreadable"),
        F.count_if(F.col("validation_status") == NO_MATCH).alias("differing"), F.count_if(below).alias("below")), out)
    got = seen.get
    return LoadFiles(out, got.get("files") or 0, got.get("rows") or 0, got.get("unreadable") or 0, got.get("differing") or 0,
                     got.get("below") or 0)


def schema_variants(spark: SparkSession, files: LoadFiles, expected: T.StructType) -> list[tuple[T.StructType, list[str]]]:
    """The schemas of a load's readable files and the paths of the files that
    have each: what the driver of a read of these files holds anyway."""
    found: dict[str | None, list[str]] = {}
    for r in files.report(spark).filter("error is null").select("schema_json", "file").collect():
        found.setdefault(r.schema_json, []).append(r.file)
    return [(expected if k is None else T.StructType.fromJson(json.loads(k)), sorted(v))
            for k, v in sorted(found.items(), key=lambda x: (x[0] is not None, x[0] or ""))]


def by_folder(files: DataFrame) -> DataFrame:
    """``folder, validation_status, n_files, n_differences, variants, n_unreadable``
    for each folder of a ``file_schema_report``: a folder matches when every file
    does. ``variants`` has the distinct lists of differences of its files (an
    empty one for files that match); n_differences counts what is in any."""
    variants = F.array_sort(F.collect_set("differences"))
    return (files.groupBy("folder")
            .agg(F.max("validation_status").alias("validation_status"), F.count("*").alias("n_files"),
                 variants.alias("variants"), F.count("error").alias("n_unreadable"))
            .select("folder", "validation_status", "n_files",
                    F.size(F.array_distinct(F.flatten("variants"))).alias("n_differences"), "variants", "n_unreadable"))


def type_clashes(variants: Sequence[Sequence], expected: T.StructType) -> dict[str, list[str]]:
    """Columns that files hold in different types, with these types. ``variants``:
    the distinct lists of differences of the files."""
    known = {f.name: f.dataType.simpleString() for f in expected.fields}
    found: dict[str, set[str]] = {}
    for column in {d.column_name for v in variants for d in v}:
        for v in variants:
            own = [d.actual_type for d in v if d.column_name == column]
            kind = own[0] if own else known.get(column)
            if kind is not None:
                found.setdefault(column, set()).add(kind)
    return {c: sorted(t) for c, t in sorted(found.items()) if len(t) > 1}


def folder_schema_report(spark: SparkSession, glob_path: str, expected: T.StructType) -> DataFrame:
    """``folder, validation_status, n_differences`` for every folder a load of
    ``glob_path`` reads: the strict verdict over all its files, which a merged
    (or single-footer) read cannot give."""
    return by_folder(file_schema_report(spark, "", glob_path, expected)).select(
        "folder", "validation_status", "n_differences")
