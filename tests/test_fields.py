import hashlib
from datetime import date

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtables.operators import fields, filters, rows
from logtables.operators.dedup import dedup
from logtables.spec import Exporter, FieldSet, FieldSpec, InvalidFieldError


def one_set(*specs, **kw):
    return FieldSet((Exporter("x", specs, kw.pop("shared", {})),), **kw)


def test_default_set_has_its_twenty_fields_in_order():
    assert fields.BASIC.names == (
        "httpStatus method httpVersion requestId instanceKey cost responseSize mcycles "
        "loadingRequest pendingTimeUsec latencyUsec timestamp host path resource nickname ip "
        "userAgent versionId moduleId").split()


def test_schema_has_modes_and_nested_fields():
    found = one_set(
        FieldSpec("a", "STRING"), FieldSpec("b", "integer", repeated=True),
        FieldSpec("c", "record", fields=(FieldSpec("d", "float"),))).schema()
    assert found == T.StructType([
        T.StructField("a", T.StringType()),
        T.StructField("b", T.ArrayType(T.LongType(), False)),
        T.StructField("c", T.StructType([T.StructField("d", T.DoubleType())]))])


@pytest.mark.parametrize("other", ["a", "A"])
def test_duplicate_names_are_refused(other):
    with pytest.raises(InvalidFieldError):
        one_set(FieldSpec("a", "string"), FieldSpec(other, "string"))


def test_unknown_type_is_refused():
    with pytest.raises(InvalidFieldError):
        one_set(FieldSpec("a", "decimal"))


def test_schema_hash_sees_the_case_of_types():
    lower, upper = one_set(FieldSpec("a", "string")), one_set(FieldSpec("a", "STRING"))
    assert lower.schema_hash() == hashlib.md5(b"astring").hexdigest()[:6]
    assert lower.schema_hash() != upper.schema_hash()
    assert lower.schema() == upper.schema()


def test_empty_set_and_empty_input(spark):
    logs = spark.createDataFrame([(1,)], "id bigint")
    empty = FieldSet(())
    assert rows.export_rows(logs, empty, ["id"]).collect() == [(1,)]
    sized = rows.export_rows(logs, empty, ["id"])
    assert sized.select(rows.row_size(sized, empty)).first()[0] == len("{}") + 1
    assert rows.export_rows(logs.limit(0), one_set(FieldSpec("id", "string"))).count() == 0


def test_null_in_a_required_field_aborts_the_write(spark, tmp_path):
    logs = spark.createDataFrame([(1, ""), (2, None)], "id bigint, name string")
    found = rows.export_rows(logs, one_set(FieldSpec("name", "string")), ["id"])
    with pytest.raises(PySparkException, match="no value for required field name"):
        found.write.parquet(str(tmp_path / "out"))
    assert not list(tmp_path.glob("out/*.parquet"))
    kept = rows.export_rows(logs, one_set(FieldSpec("name", "string", nullable=True)), ["id"])
    assert kept.collect() == [(1, ""), (2, None)]


def test_dates_in_integer_fields_become_millis(spark):
    logs = spark.createDataFrame([(date(1970, 1, 2),)], "d date")
    found = rows.export_rows(logs, one_set(
        FieldSpec("one", "integer", "d"), FieldSpec("many", "integer", "array(d)", repeated=True)))
    assert found.first() == (86_400_000, [86_400_000])


def test_path_rule(spark):
    logs = spark.createDataFrame([("?a",), ("/x#t",), ("/x?a?b",), ("",)], "resource string")
    found = rows.export_rows(logs, one_set(fields.URL.fields[1]))
    assert [r.path for r in found.collect()] == ["", "/x#t", "/x", ""]


def test_fields_share_a_vectorised_udf(spark):
    @F.pandas_udf("first string, size bigint")
    def parts(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"first": text.str[:1], "size": text.str.len()})

    logs = spark.createDataFrame([("abc",), ("de",)], "t string")
    found = rows.export_rows(logs, one_set(
        FieldSpec("initial", "string", "p.first"), FieldSpec("length", "integer", F.col("p.size")),
        shared={"p": parts("t")}))
    assert found.collect() == [("a", 3), ("d", 2)]


def java_text(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list):
        return "[" + ", ".join(map(java_text, value)) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k}={java_text(v)}" for k, v in value.items()) + "}"
    return str(value)


def test_row_bytes_of_nested_rows(spark):
    cases = [
        {"s": "héé", "n": None, "l": ["a", None, "ß"], "r": {"x": 1, "y": None}, "b": True},
        {"s": "", "n": -5, "l": [], "r": None, "b": False},
    ]
    logs = spark.createDataFrame(
        cases, "s string, n bigint, l array<string>, r struct<x:bigint,y:string>, b boolean")
    spec = one_set(
        FieldSpec("s", "string"), FieldSpec("n", "integer", nullable=True),
        FieldSpec("l", "string", repeated=True),
        FieldSpec("r", "record", nullable=True,
                  fields=(FieldSpec("x", "integer"), FieldSpec("y", "string"))),
        FieldSpec("b", "boolean"))
    found = rows.export_rows(logs, spec)
    sizes = [r[0] for r in found.select(rows.row_size(found, spec)).collect()]
    assert sizes == [len(java_text(c).encode()) + 1 for c in cases]


def test_valid_and_rejected_rows_make_up_the_input(spark):
    logs = spark.createDataFrame(
        [("1", "5", "ok"), ("2", "x", "ok"), ("3", "7", "long" * 10), ("4", "y", "long" * 10)],
        "id string, n string, s string")
    spec = one_set(FieldSpec("requestId", "string", "id"), FieldSpec("n", "integer"),
                   FieldSpec("s", "string"))
    checked = rows.checked_rows(logs, spec, max_row_bytes=40)
    good = rows.valid_rows(checked, spec)
    bad = rows.reject_rows(checked, spec)
    assert good.collect() == [("1", 5, "ok")]
    assert sorted((r.request_id, r.reason) for r in bad.collect()) == [
        ("2", "bad_type"), ("3", "oversize"), ("4", "bad_type"), ("4", "oversize")]
    lengths = {r.request_id: r.field_lengths for r in bad.collect() if r.reason == "oversize"}
    assert lengths["4"] == {"requestId": 1, "n": 1, "s": 40}


def test_filters(spark):
    logs = spark.createDataFrame(
        [(1, [(0,), (3,)], "v1", "a", None), (2, [], "v1", "b", "x"), (3, None, "v2", "a", "y")],
        "id bigint, app_logs array<struct<level:int>>, version_id string, module_id string, s string")

    def ids(df):
        return [r.id for r in df.orderBy("id").collect()]

    assert ids(filters.min_level(logs, 3)) == [1]
    assert ids(filters.min_level(logs, 4)) == []
    assert ids(filters.min_level(logs, None)) == [1, 2, 3]
    assert ids(filters.versions(logs, [("v1", "b"), ("v2", "a")])) == [2, 3]
    assert ids(filters.versions(logs, [])) == ids(filters.versions(logs, None)) == [1, 2, 3]
    table = spark.createDataFrame([("v1", "a")], "version_id string, module_id string")
    assert ids(filters.versions(logs, table)) == [1]
    assert ids(filters.skip(logs, "s = 'x'")) == [1, 3]
    assert ids(filters.skip(logs, F.col("s") == "y")) == [1, 2]


def test_dedup_keeps_a_fixed_copy_and_is_idempotent(spark):
    sent = spark.createDataFrame([("a", 3, "late"), ("a", 1, "first"), ("b", 2, "only")],
                                 "requestId string, at bigint, s string")
    once = dedup(sent, first_by=["at"])
    assert sorted(once.collect()) == [("a", 1, "first"), ("b", 2, "only")]
    assert sorted(dedup(once, first_by=["at"]).collect()) == sorted(once.collect())
    assert dedup(sent).count() == 2
    assert dedup(sent, key=None).count() == 3


def test_records_are_built_by_name_and_parts_are_checked(spark):
    logs = spark.sql("""
        SELECT 'r1' AS id, named_struct('userAgent', 'ua', 'n', 'x', 'ip', '1.1') AS c,
               array('1', 'x') AS a, 1.7D AS f
        UNION ALL SELECT 'r2', named_struct('userAgent', 'ub', 'n', '7', 'ip', '2.2'),
               array('1', '2'), 2.0D""")
    record = FieldSpec("client", "record", "c", fields=(
        FieldSpec("ip", "string"), FieldSpec("userAgent", "string"), FieldSpec("n", "integer")))
    both = one_set(FieldSpec("requestId", "string", "id"), record,
                   FieldSpec("items", "integer", "a", repeated=True),
                   FieldSpec("number", "integer", "f"))
    checked = rows.checked_rows(logs, both, 1000)
    good = rows.valid_rows(checked, both).collect()
    assert [(r.requestId, tuple(r.client), r["items"], r.number) for r in good] == [
        ("r2", ("2.2", "ub", 7), [1, 2], 2)]
    bad = rows.reject_rows(checked, both).collect()
    assert sorted(r.message for r in bad) == [
        "Value of client is not of type record", "Value of items is not of type integer",
        "Value of number is not of type integer"]
    assert {r.request_id for r in bad} == {"r1"}
    with pytest.raises(PySparkException, match="altered"):
        rows.export_rows(logs, one_set(FieldSpec("number", "integer", "f"))).collect()
    with pytest.raises(InvalidFieldError, match="no value for ip"):
        rows.export_rows(logs.withColumn("c", F.expr("named_struct('userAgent', 'x', 'n', '1')")),
                         one_set(record))


def test_shared_columns_stay_with_their_exporter(spark):
    logs = spark.createDataFrame([("r", "1.1")], "id string, ip string")
    one = Exporter("one", (FieldSpec("a", "string", "ip"), FieldSpec("b", "string", "own")),
                   shared={"ip": "concat('hidden', ip)", "own": "'x'"})
    two = Exporter("two", (FieldSpec("c", "string", "ip"), FieldSpec("d", "string", "own")),
                   shared={"own": "'y'"})
    assert tuple(rows.export_rows(logs, FieldSet((one, two)), ["ip"]).first()) == (
        "1.1", "hidden1.1", "x", "1.1", "y")
