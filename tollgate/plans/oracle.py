"""Independent SQL (DuckDB) for every query key of the catalog.

Spark's ``rlike`` is Java regex ``find()``; DuckDB's ``regexp_matches`` is
RE2 search. They differ on line terminators only, so rule patterns are
translated here, for the oracle and never for Spark: an unescaped ``.``
outside a class excludes the five Java line terminators, and ``$`` may be
followed by one final terminator. NULL logic needs no help: ``NOT
regexp_matches(NULL, p)`` is NULL in both engines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

from ..functions.rules import CAST_REGEX, NOT_NULL, Rule

_DOT = r"[^\n\r\x{85}\x{2028}\x{2029}]"
_EOL = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"


def java_to_re2(pattern: str) -> str:
    out: list[str] = []
    i, in_class = 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            in_class = c != "]"
            out.append(c)
        elif c == "[":
            in_class = True
            out.append(c)
            # a ']' right after '[' or '[^' is a literal member
            if pattern[i + 1:i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1:i + 2] == "]":
                out.append("]")
                i += 1
        elif c == ".":
            out.append(_DOT)
        elif c == "$":
            out.append(_EOL)
        else:
            out.append(c)
        i += 1
    return "".join(out)


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def violation_sql(rule: Rule) -> str:
    col = ident(rule.column)
    if rule.kind == NOT_NULL:
        return f"({col} is null)"
    if rule.kind == CAST_REGEX:
        col = f"cast({col} as varchar)"
    bad = f"(not regexp_matches({col}, {sql_str(java_to_re2(rule.pattern))}))"
    if not rule.nullable:
        bad = f"({col} is null or {bad})"
    return bad


def violated_sql(rule: Rule) -> str:
    return f"coalesce({violation_sql(rule)}, false)"


def failed_sql(rules: Sequence[Rule]) -> str:
    """Comma-joined names of violated rules ('' when none)."""
    arms = ", ".join(f"case when {violation_sql(r)} then {sql_str(r.name)} end" for r in rules)
    return f"concat_ws(',', {arms})"


def any_violation_sql(rules: Sequence[Rule]) -> str:
    return "(" + " or ".join(violated_sql(r) for r in rules) + ")" if rules else "false"


def annotated_sql(base_sql: str, rules: Sequence[Rule]) -> str:
    """``base.*, failed, validation`` over a sub-select."""
    return (f"select *, case when failed = '' then 'match' else 'no_match' end as validation\n"
            f"from (select b.*, {failed_sql(rules)} as failed from ({base_sql}) b) x")


# --- schema oracle ----------------------------------------------------------------

def duck_type(dt: T.DataType) -> str:
    """DuckDB's spelling of a Spark type, as ``information_schema`` prints it."""
    simple = {
        T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER",
        T.ShortType: "SMALLINT", T.ByteType: "TINYINT", T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
        T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.BinaryType: "BLOB",
    }
    for cls, name in simple.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.ArrayType):
        return duck_type(dt.elementType) + "[]"
    if isinstance(dt, T.MapType):
        return f"MAP({duck_type(dt.keyType)}, {duck_type(dt.valueType)})"
    if isinstance(dt, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {duck_type(f.dataType)}" for f in dt.fields) + ")"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    raise ValueError(f"no DuckDB spelling for {dt.simpleString()}")


# DuckDB type name -> Spark simple string, written out in SQL (oracle side)
SPARK_TYPE_SQL = """case {c}
    when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
    when 'SMALLINT' then 'smallint' when 'TINYINT' then 'tinyint' when 'DOUBLE' then 'double'
    when 'FLOAT' then 'float' when 'BOOLEAN' then 'boolean' when 'DATE' then 'date'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'TIMESTAMP WITH TIME ZONE' then 'timestamp'
    when 'BLOB' then 'binary' when 'FLOAT[]' then 'array<float>' when 'DOUBLE[]' then 'array<double>'
    when 'VARCHAR[]' then 'array<string>' when 'BIGINT[]' then 'array<bigint>'
    when 'INTEGER[]' then 'array<int>' else lower({c}) end"""


def expected_fields_sql(expected: Mapping[tuple[str, str], T.StructType]) -> str:
    rows = []
    for (source, layer), schema in expected.items():
        for i, f in enumerate(schema.fields):
            rows.append(f"({sql_str(source)}, {sql_str(layer)}, {i + 1}, {sql_str(f.name)}, "
                        f"{sql_str(duck_type(f.dataType))}, {sql_str(f.dataType.simpleString())})")
    return ("select * from (values\n  " + ",\n  ".join(rows) +
            "\n) as e(source, layer, pos, column_name, duck_type, spark_type)")


def actual_fields_sql(tables: Mapping[tuple[str, str], str]) -> str:
    """``tables`` maps (source, layer) -> a registered view name, or a SELECT
    (described with DESCRIBE, positions in column order)."""
    parts = []
    for (source, layer), rel in tables.items():
        if rel.lstrip().lower().startswith("select"):
            parts.append(
                f"select {sql_str(source)} as source, {sql_str(layer)} as layer, "
                f"cast(row_number() over () as integer) as pos, column_name, column_type as duck_type "
                f"from (describe {rel})")
        else:
            parts.append(
                f"select {sql_str(source)} as source, {sql_str(layer)} as layer, "
                f"cast(ordinal_position as integer) as pos, column_name, data_type as duck_type "
                f"from information_schema.columns where table_name = {sql_str(rel)}")
    return "\nunion all\n".join(parts)


def schema_report_sql(expected, tables) -> str:
    return f"""
with e as ({expected_fields_sql(expected)}),
a as ({actual_fields_sql(tables)})
select coalesce(e.source, a.source) as source, coalesce(e.layer, a.layer) as layer,
       case when count(*) filter (where e.column_name is distinct from a.column_name
                                     or e.duck_type is distinct from a.duck_type) = 0
            then 'match' else 'no_match' end as validation_status
from e full join a on e.source = a.source and e.layer = a.layer and e.pos = a.pos
group by 1, 2"""


def schema_diff_sql(expected, tables) -> str:
    """``moved``: another place among the columns that both schemas have."""
    return f"""
with e as ({expected_fields_sql(expected)}),
a as ({actual_fields_sql(tables)}),
c as (select e.source, e.layer, e.column_name,
             row_number() over (partition by e.source, e.layer order by e.pos) as e_rank,
             row_number() over (partition by e.source, e.layer order by a.pos) as a_rank
      from e join a on e.source = a.source and e.layer = a.layer and e.column_name = a.column_name)
select coalesce(e.source, a.source) as source, coalesce(e.layer, a.layer) as layer,
       coalesce(e.column_name, a.column_name) as column_name,
       cast(e.pos as integer) as expected_position, cast(a.pos as integer) as actual_position,
       e.spark_type as expected_type, {SPARK_TYPE_SQL.format(c='a.duck_type')} as actual_type,
       case when a.pos is null then 'missing' when e.pos is null then 'unexpected'
            when e.duck_type <> a.duck_type then 'type_mismatch'
            when c.e_rank <> c.a_rank then 'moved' else 'match' end as status
from e full join a on e.source = a.source and e.layer = a.layer and e.column_name = a.column_name
left join c on c.source = e.source and c.layer = e.layer and c.column_name = e.column_name"""
