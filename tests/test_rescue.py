"""Every field of a JSON record is in its column or in `_rescued_data`, and in one of them only."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import types as T

from ledgerwatch.sources import rescue
from ledgerwatch.sources.readers import read_files
from ledgerwatch.streaming.ingest import StreamTable, ingest_files, read_table, run_to_end


def lines(folder, name, *records):
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder) / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return str(path)


def rows_of(found):
    return [json.loads(x) for x in found.toJSON().collect()]


def test_columns_grow_at_depth_two_and_inside_lists(spark, folder):
    known = None
    a = lines(folder, "a.json", {"id": 1, "p": {"x": 1, "q": {"u": 1}}, "l": [{"m": 1}]})
    b = lines(folder, "b.json", {"id": 2, "p": {"x": 2, "y": "kept", "q": {"u": 2, "v": True}}, "l": [{"m": 2, "n": [{"deep": 0.5}]}, {"m": 3}]})
    _, known = read_files(spark, [a], "json")
    found, schema = read_files(spark, [b], "json", known)
    assert schema.simpleString() == "struct<id:bigint,l:array<struct<m:bigint,n:array<struct<deep:double>>>>,p:struct<q:struct<u:bigint,v:boolean>,x:bigint,y:string>>"
    assert rows_of(found) == [{"id": 2, "l": [{"m": 2, "n": [{"deep": 0.5}]}, {"m": 3}], "p": {"q": {"u": 2, "v": True}, "x": 2, "y": "kept"}}]


def test_older_rows_are_read_with_nested_columns_that_came_later(spark, folder):
    table = StreamTable(f"{folder}/t")
    for name, record in (("a.json", {"id": 1, "p": {"x": 1}, "l": [{"m": 1}]}), ("b.json", {"id": 2, "p": {"x": 2, "y": 3}, "l": [{"m": 2, "n": 4}]})):
        lines(f"{folder}/raw", name, record)
        run_to_end(ingest_files(spark, f"{folder}/raw", "json", table))
    found = {r.id: (r.p.x, r.p.y, r.l[0].m, r.l[0].n, r._rescued_data) for r in read_table(spark, table).collect()}
    assert found == {1: (1, None, 1, None, None), 2: (2, 3, 2, 4, None)}


KNOWN = "id long, amount long, name string, p struct<x: long, q: struct<u: double>>, l array<struct<m: long>>, n array<long>, `a b.c` boolean"
CASES = [
    ({"id": 1, "amount": 5, "name": "a", "p": {"x": 1, "q": {"u": 2}}, "l": [{"m": 1}], "n": [1, 2], "a b.c": True}, None),
    ({"id": 2, "amount": 5.75}, {"amount": 5.75}),
    ({"id": 3, "Amount": 9}, {"Amount": 9}),
    ({"id": 4, "amount": 1, "AMOUNT": 2}, {"AMOUNT": 2}),
    ({"id": 5, "p": {"x": "no", "y": 1, "q": {"u": 1.5, "U": 2}}}, {"p": {"x": "no", "y": 1, "q": {"U": 2}}}),
    ({"id": 6, "p": [1]}, {"p": [1]}),
    ({"id": 7, "l": [{"m": 1}, {"m": 2, "k": 3}, {"m": "x"}]}, {"l": [None, {"k": 3}, {"m": "x"}]}),
    ({"id": 12, "l": [{"m": 1}, 4], "n": [1, "x"]}, {"l": [{"m": 1}, 4], "n": [1, "x"]}),
    ({"id": 8, "l": {"m": 1}, "new": None, "e": {}}, {"l": {"m": 1}, "new": None, "e": {}}),
    ({"id": 9, "amount": None, "p": None, "l": None, "n": None}, None),
    ({"id": 10, "name": {"is": "an object"}, "a b.c": "yes"}, {"a b.c": "yes"}),
    ({"id": "eleven", "name": 5}, {"id": "eleven"}),
    ({}, None),
]


def test_rescued_fields(spark, folder):
    path = lines(folder, "a.json", *(record for record, _ in CASES), "nope", "[1, 2]", '{"id": 1, "id": 2}', '"text"')
    found = rescue.with_rescue(rescue.records(spark, [path], False), T.StructType.fromDDL(KNOWN)).collect()
    for row, (record, left) in zip(found, CASES):
        assert (json.loads(row[rescue.RESCUE]) if row[rescue.RESCUE] else None) == left, record
    by_id = {r["id"]: r for r in found if r["id"] is not None}
    assert by_id[5]["p"]["q"]["u"] == 1.5 and by_id[4]["amount"] == 1 and by_id[10]["name"] == '{"is":"an object"}'
    # Whatever is no object is kept whole; the items of a list are records.
    assert [r[rescue.RESCUE] for r in found[len(CASES) :]] == ["nope", "1", "2", '{"id": 1, "id": 2}', '"text"']


def test_nothing_is_lost_and_nothing_twice(spark, folder):
    """Random records: columns and rescued fields together give back the record."""
    rng = random.Random(7)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        return [None, rng.randrange(5), rng.choice(["x", "", "5"]), rng.random() < 0.5][kind] if kind < 4 else thing(depth - 1) if kind < 6 else [value(depth - 1) for _ in range(rng.randrange(3))]

    def thing(depth):
        return {rng.choice("abcAB"): value(depth) for _ in range(rng.randrange(4))}

    def together(own, left):
        """What the two sides say; nulls and empty objects say nothing."""
        if isinstance(own, dict) or isinstance(left, dict):
            own, left = own or {}, left or {}
            if not isinstance(own, dict) or not isinstance(left, dict):
                return own or left
            return {k: t for k in {**own, **left} if (t := together(own.get(k), left.get(k))) not in (None, {}, [])}
        if isinstance(own, list) or isinstance(left, list):
            own, left = own or [], left or []
            size = max(len(own), len(left))
            return [together(*(side[k] if k < len(side) else None for side in (own, left))) for k in range(size)]
        assert own is None or left is None
        return own if left is None else left

    given = [{"key": k, **{n: v for n, v in thing(3).items()}} for k in range(300)]
    paths = [lines(folder, f"{k}.json", *given[k * 100 : k * 100 + 100]) for k in range(3)]
    known, found = None, []
    for path in paths:
        rows, known = read_files(spark, [path], "json", known)
        found += rows_of(rows)
    for row in found:
        left = json.loads(row.pop(rescue.RESCUE, "null"))
        told = together(row, left)
        record = given[row["key"]]
        texts = json.dumps(told, sort_keys=True), json.dumps(together(record, None), sort_keys=True)
        # A column of text holds other values as their JSON text.
        assert texts[0] == texts[1] or _loose(told) == _loose(together(record, None)), (record, row, left)


def _loose(x):
    """A value with every text that is JSON, and every plain value, as its text."""
    if isinstance(x, dict):
        return {k: v for k in x if (v := _loose(x[k])) not in ("null", {}, [])}
    if isinstance(x, list):
        return [_loose(v) for v in x]
    if isinstance(x, str):
        try:
            inner = json.loads(x)
        except ValueError:
            return x
        return _loose(inner) if isinstance(inner, (dict, list)) else x
    return json.dumps(x)


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2}]', '{"id": 1,\n "p": {"x": 2}}'])
def test_multi_line(spark, folder, text):
    path = lines(folder, "a.json", text)
    found, schema = read_files(spark, [path], "json", multi_line=True)
    assert [r.id for r in found.collect()] == ([1, 2] if text[0] == "[" else [1])


def test_inferred_types(spark, folder):
    path = lines(folder, "a.json", {"i": 1, "d": 1, "t": 1, "o": {}, "v": None, "Q": 1, "`": [[1]], "OBJECT<": {"VOID": 1}}, {"d": 0.5, "t": "x", "q": "2", "lv": [None]})
    schema = rescue.merged(T.StructType(), rescue.found_columns(rescue.records(spark, [path], False)))
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds == {"Q": "bigint", "`": "array<array<bigint>>", "OBJECT<": "struct<VOID:bigint>", "d": "double", "i": "bigint", "lv": "array<string>", "t": "string", "v": "string"}
    assert rescue.found_columns(rescue.records(spark, [lines(folder, "b.json", "nope")], False)) == T.StructType()


def test_without_growth(spark, folder):
    known = T.StructType.fromDDL("id long")
    path = lines(folder, "a.json", {"id": 1, "more": {"x": [1]}})
    found, schema = read_files(spark, [path], "json", known, grow=False)
    assert schema == known and rows_of(found) == [{"id": 1, rescue.RESCUE: '{"more":{"x":[1]}}'}]
