import json
import sys

from hypothesis import given, settings
from hypothesis import strategies as st

from loomcast.operators import shred as S

sys.setrecursionlimit(S.MOST_FRAMES)  # as the operator does; hypothesis wants it unchanged during a test


def brute(value, path, out):
    if isinstance(value, dict):
        for k, x in value.items():
            brute(x, f"{path}.{k}" if path else k, out)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            at = f"{path}[{i}]"
            if isinstance(x, dict):
                out.append(at)
            brute(x, at, out)
    return out


values = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=3),
    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("abcd"), c, max_size=3),
    max_leaves=25,
)


@settings(max_examples=400, deadline=None)
@given(st.dictionaries(st.sampled_from("wxyz"), values, max_size=3))
def test_levels_tell_every_object(record):
    got = [r[0] for r in S.rebuild(S.shred(record))]
    assert sorted(got) == sorted(brute(record, "", []))
    assert len(got) == len(set(got))


def node_paths(text):
    record = S.read_record(text)
    return None if record is None else sorted(r[0] for r in S.rebuild(S.shred(record)))


def test_defined_cases():
    assert node_paths(None) is None and node_paths("") is None and node_paths("null") is None and node_paths("[]") is None
    assert node_paths("{'a': 1}") is None and node_paths('{"a": [') is None and node_paths('{"a": NaN}') is None
    assert node_paths("{}") == []
    assert node_paths('{"a": [null, {}, 3, {"b": [[{"c": 1}]]}]}') == ["a[1]", "a[3]", "a[3].b[0][0]"]
    assert node_paths("[" * 100_000) is None
    assert node_paths('{"a":' * 5000 + "1" + "}" * 5000) == []
    assert len(node_paths('{"a":' + '[{"b":' * 1200 + "1" + "}]" * 1200 + "}")) == 1200
    text = '{"a": [{}]}'
    for _ in range(9):
        text = json.dumps(text)
    assert node_paths(text) == ["a[0]"]


def test_text_counts_as_what_it_holds():
    inner = {"source_data": {"youtube": json.dumps({"formats": [{"tag": 1, "fragments": [{"seq": 1}]}]})}, "people": {"name": "x"}, "assets": {"chapters": {"url": "u"}}}
    want = ["assets.chapters[0]", "people[0]", "source_data.youtube.formats[0]", "source_data.youtube.formats[0].fragments[0]"]
    assert node_paths(json.dumps(inner)) == want
    assert node_paths(json.dumps(json.dumps(inner))) == want


def test_parents_and_fields():
    rows = S.rebuild(S.shred({"a": [{"n": 1, "d": {"w": 2}, "b": [None, {"k": "x"}]}]}))
    by = {r[0]: r for r in rows}
    assert by["a[0]"][1] == "" and by["a[0]"][5] == {"n": "1", "d.w": "2"}
    assert by["a[0].b[1]"][1] == "a[0]" and by["a[0].b[1]"][3] == 1 and by["a[0].b[1]"][5] == {"k": "x"}


def test_table_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "a"), (1, '{"p": [{"q": 1}]}', "b"), (1, '{"p": [{"q": 1}]}', "b"), (None, '{"p": [{"q": "\\ud83d"}]}', "c")]
    df = spark.createDataFrame(rows, "id long, metadata_json string, node_path string")
    out = S.nodes(df).collect()
    assert sorted((r.id or 0, r.node_path) for r in out) == [(0, "p[0]"), (1, "p[0]"), (1, "p[0]")]
    assert S.nodes(df.where("false")).count() == 0
    child = S.child_table(S.nodes(df), "p[]", ["q", "missing"]).where("id = 1").first()
    assert child.q == "1" and child.missing is None


def test_levels_table(spark):
    df = spark.createDataFrame([(7, '{"a": [{"b": [1, 2]}, {"b": []}, {"b": [3]}]}')], "id long, metadata_json string")
    r = S.levels(df).where("leaf_path = 'a[].b[]'").first()
    assert (r.value, r.rep) == (["1", "2", None, "3"], [0, 2, 1, 1])


def test_deep_records_beside_others(spark):
    deep = '{"a":' + '[{"b":' * 1200 + "1" + "}]" * 1200 + "}"
    escaped = '"\\u007b\\"p\\": [\\u007b}]}"'
    rows = [(1, '{"p": [{"q": 1}]}'), (2, deep), (3, '{"a":' * 5000 + "1" + "}" * 5000), (4, "[" * 200_000), (5, '{"p": [{"q": 1}]}'), (6, escaped)]
    df = spark.createDataFrame(rows, "id long, metadata_json string")
    got = {r.id: r["count"] for r in S.nodes(df).groupBy("id").count().collect()}
    assert got == {1: 1, 2: 1200, 5: 1, 6: 1}
    assert S.levels(df).where("id = 2").first().leaf_path.count("[]") == 1200
