"""JSON documents by path against Python's own reading of them."""

import json
from collections import Counter

import pytest

from tidemark.operators import json_shape as J

DOCS = [
    '{"a": 1, "b": {"c": "x", "d": [1, 2.5, {"e": true}]}, "n": null}', '{"a": "s", "b": []}', "bad{", "3", '"t"', "[]",
    None, "", "null", '{"a.b": 1, "a b": 2, "q\\"": 3, "z": 12345678901234567890, "f": 1.5e3}', '[[1], [2, "x"], {"a": 1}]',
    '{"a": 1, "b": {"c": "x", "d": [1, 2.5, {"e": true}]}, "n": null}',
]


def kind(x):
    if isinstance(x, bool):
        return "boolean"
    names = {dict: "object", list: "array", str: "string", int: "integer", float: "decimal", type(None): "null"}
    return names[type(x)]


def walk(path, x):
    yield path, kind(x)
    if isinstance(x, dict):
        for k, v in x.items():
            plain = k.isidentifier()
            yield from walk(f"{path}.{k}" if plain else f"{path}[{json.dumps(k)}]", v)
    if isinstance(x, list):
        for v in x:
            yield from walk(f"{path}[*]", v)


def by_hand(docs):
    values, documents = Counter(), Counter()
    for d in docs:
        try:
            found = list(walk("$", json.loads(d))) if d is not None else [("$", "absent")]
        except ValueError:
            found = [("$", "invalid")]
        values.update(found)
        documents.update(set(found))
    return {k: (n, documents[k]) for k, n in values.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, d, "x") for i, d in enumerate(DOCS)], "id int, doc string, path string")


def test_paths_kinds_and_counts(docs):
    got = {(r["path"], r["kind"]): (r["values"], r["documents"]) for r in J.json_paths(docs, "doc").collect()}
    assert got == by_hand(DOCS)


def test_depth_limit_counts_what_holds_the_rest(docs):
    got = {(r["path"], r["kind"]) for r in J.json_paths(docs, "doc", depth=2).collect()}
    assert ("$.b", "object") in got and not any("$.b." in p for p, _ in got)


def test_drift(docs):
    paths = J.json_paths(docs, "doc")
    got = {r["path"]: r for r in J.json_drift(paths, {"$.a": "integer", "$.gone": "string", "$.n": "string"}).collect()}
    assert (got["$.a"]["fitting"], got["$.a"]["other"], got["$.a"]["found"]) == (2, 1, ["integer", "string"])
    assert got["$.gone"]["found"] == [] and got["$.gone"]["fitting"] == 0
    assert got["$.n"]["fitting"] == 2 and got["$.b.c"]["declared"] is None and got["$.b.c"]["other"] == 2


def test_typed_columns_and_their_report(docs):
    shape = {"a": ("$.a", "int"), "d": ("$.b.d", "array<double>"), "n": ("$.n", "string")}
    got = {r["id"]: (r["a"], r["d"], r["n"]) for r in J.json_columns(docs, "doc", shape).collect()}
    assert got[0] == (1, [1.0, 2.5, None], None) and got[1] == (None, None, None) and got[2] == (None, None, None)
    report = {r["column_name"]: tuple(r)[1:] for r in J.json_column_report(docs, "doc", shape).collect()}
    assert report == {"a": (12, 2, 1), "d": (12, 2, 0), "n": (12, 0, 0)}
    with pytest.raises(ValueError, match="exist already"):
        J.json_columns(docs, "doc", {"path": ("$.a", "int")})


def test_empty(spark, docs):
    assert J.json_paths(docs.limit(0), "doc").collect() == []
