"""Nested schemas merged and rows rebuilt to them."""
import pytest
from pyspark.sql.types import StructType

from runlens.sinks import schema_merge as M
from runlens.sinks import tables as K


def schema(ddl):
    return StructType.fromDDL(ddl)


def flat(s):
    return s.simpleString()


@pytest.mark.parametrize("a,b,merged", [
    ("a int, b string", "c date, A long", "a bigint, b string, c date"),
    ("s struct<x:int,y:struct<p:string>>", "s struct<z:double,y:struct<q:int,P:string>,X:double>",
     "s struct<x:double,y:struct<p:string,q:int>,z:double>"),
    ("l array<struct<a:int>>", "l array<struct<b:int,a:bigint>>", "l array<struct<a:bigint,b:int>>"),
    ("m map<string,int>", "m map<string,double>", "m map<string,double>"),
    ("d decimal(5,2)", "d decimal(9,4)", "d decimal(9,4)"), ("d decimal(5,2)", "d int", "d decimal(12,2)"),
    ("f float", "f int", "f double"), ("t date", "t timestamp", "t timestamp"), ("v void", "v struct<a:int>", "v struct<a:int>"),
])
def test_merge(spark, a, b, merged):
    assert flat(M.merged_schema(schema(a), schema(b))) == flat(schema(merged))


@pytest.mark.parametrize("a,b", [("a string", "a int"), ("a struct<x:int>", "a array<int>"), ("a boolean", "a long"),
                                 ("s struct<l:array<date>>", "s struct<l:array<int>>")])
def test_no_common_type(spark, a, b):
    with pytest.raises(M.Incompatible):
        M.merged_schema(schema(a), schema(b))


def test_rows_are_rebuilt_at_every_depth(spark):
    have = "Id int, s struct<y:struct<p:int>,x:int>, l array<struct<a:int>>, m map<int,struct<v:int>>"
    want = "x date, id bigint, s struct<x:double,y:struct<q:string,p:bigint>>, l array<struct<b:string,a:bigint>>, m map<bigint,struct<v:double,w:int>>"
    rows = [(1, ((2,), 3), [(4,), None], {5: (6,), 7: None}), (None, None, None, None), (2, (None, None), [], {})]
    out = M.conformed_rows(spark.createDataFrame(rows, have), schema(want))
    assert flat(out.schema) == flat(schema(want))
    assert [r.asDict(recursive=True) for r in out.collect()] == [
        {"x": None, "id": 1, "s": {"x": 3.0, "y": {"q": None, "p": 2}}, "l": [{"b": None, "a": 4}, None],
         "m": {5: {"v": 6.0, "w": None}, 7: None}},
        {"x": None, "id": None, "s": None, "l": None, "m": None},
        {"x": None, "id": 2, "s": {"x": None, "y": None}, "l": [], "m": {}}]


@pytest.mark.parametrize("have,want", [("a bigint", "a int"), ("a double", "a bigint"), ("a struct<x:int,y:int>", "a struct<x:int>"),
                                       ("a int, b int", "a int"), ("l array<bigint>", "l array<int>"), ("m map<string,double>", "m map<string,float>")])
def test_narrowing_is_refused(spark, have, want):
    with pytest.raises(M.Incompatible):
        M.conformed_rows(spark.createDataFrame([], schema(have)), schema(want))


def test_replace_and_append_nested(spark):
    spark.sql("DROP TABLE IF EXISTS t_nested")
    K.replace_table(spark.createDataFrame([(1, (1, "old"))], "id int, s struct<a:int,gone:string>"), "t_nested")
    K.replace_table(spark.createDataFrame([(2, ("new", 2**40))], "id int, s struct<b:string,a:bigint>"), "t_nested")
    assert flat(spark.table("t_nested").schema) == "struct<id:int,s:struct<b:string,a:bigint,gone:string>>"
    K.append_conformed(spark.createDataFrame([((5,), 3)], "s struct<a:int>, id int"), "t_nested")
    spark.catalog.refreshTable("t_nested")
    assert {tuple(r.s) for r in spark.table("t_nested").collect()} == {("new", 2**40, None), (None, 5, None)}
    with pytest.raises(M.Incompatible):
        K.append_conformed(spark.createDataFrame([(2**40, None)], "id bigint, s struct<a:int>"), "t_nested")
