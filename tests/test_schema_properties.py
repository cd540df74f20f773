"""Properties of the driver-side schema diff over random schema edits."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tollgate.operators.schemas import expected_schema, schema_diff_rows

BASE = expected_schema("mongodb", "silver")
TYPES = [T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()]


@st.composite
def edited(draw):
    fields = list(BASE.fields)
    fields = draw(st.permutations(fields))
    keep = draw(st.lists(st.booleans(), min_size=len(fields), max_size=len(fields)))
    fields = [f for f, k in zip(fields, keep) if k]
    out = []
    for f in fields:
        op = draw(st.sampled_from(["same", "same", "upper", "retype"]))
        if op == "upper":
            f = T.StructField(f.name.upper(), f.dataType, f.nullable)
        elif op == "retype" and not isinstance(f.dataType, T.ArrayType):
            f = T.StructField(f.name, draw(st.sampled_from(TYPES)), f.nullable)
        out.append(f)
    extra = draw(st.lists(st.sampled_from(["x1", "x2", "x3"]), unique=True, max_size=2))
    out += [T.StructField(n, T.StringType()) for n in extra]
    return T.StructType(out)


@settings(max_examples=200, deadline=None)
@given(edited())
def test_diff_invariants(actual):
    rows = schema_diff_rows("s", "silver", actual, BASE)
    names = [r[2] for r in rows]
    exp_names, act_names = BASE.fieldNames(), actual.fieldNames()
    # one row per name in the union, expected order first
    assert names == exp_names + [n for n in act_names if n not in exp_names]
    status = {r[2]: r[-1] for r in rows}
    for n in exp_names:
        assert (status[n] == "missing") == (n not in act_names)
    for n in act_names:
        assert (status[n] == "unexpected") == (n not in exp_names)
    # the strict verdict is "match" exactly when every field row matches
    assert (actual == BASE) == all(s == "match" for s in status.values())
    for r in rows:
        if r[-1] == "moved":
            # another place among the columns that both have
            both = [n for n in exp_names if n in act_names], [n for n in act_names if n in exp_names]
            assert both[0].index(r[2]) != both[1].index(r[2]) and r[5] == r[6]
        if r[-1] == "type_mismatch":
            assert r[5] != r[6]
