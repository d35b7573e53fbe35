import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loomcast.llm import leaks as L


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_index_finds_every_place(text, pattern):
    index = L.FmIndex(np.array(text), 3, rate=3)
    low, high = index.search(np.array([pattern]))
    got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert got == [i for i in range(len(text) - len(pattern) + 1) if text[i : i + len(pattern)] == pattern]


def brute(docs, items, n=4, c=5):
    out = set()
    for d, t in docs:
        w = L.words(L._MARKUP.sub(" ", t or ""))
        grams = {k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for k in (n, c)}
        for i, lang, x in items:
            k = c if lang in ("zh", "ja") else n
            v = L.words(x or "")
            if any(tuple(v[j : j + k]) in grams[k] for j in range(len(v) - k + 1)):
                out.add((d, i))
    return out


texts = st.lists(st.sampled_from(["a", "b", "B", "c", "<b>", "x<y", "我", "们", "，", "\n"]), max_size=25).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(texts | st.none(), max_size=6), st.lists(st.tuples(st.sampled_from(["en", "zh", None]), texts | st.none()), max_size=5))
def test_shard_against_brute_force(docs, items):
    docs, items = list(enumerate(docs)), [(i, *x) for i, x in enumerate(items)]
    what = L.phrases(items, 4, 5)
    got = {(d, i) for d, i, _ in L.search_shard([d for d, _ in docs], [t for _, t in docs], what)}
    assert got == brute(docs, items)


def test_table(spark):
    words = " ".join(f"w{i}" for i in range(20))
    docs = [(1, "before " + words + " after", "x"), (2, None, "x"), (3, "", "x"), (4, words.replace("w5", "<b>w5</b>"), "x"), (5, " ".join(words.split()[:11]), "x"), (6, (words + " ") * 3000, "x")]
    items = [(10, "s", "en", words.upper(), "a"), (11, "s", "en", words, "a"), (12, "s", "en", "too short", "a"), (13, "s", None, None, "a")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, suite string, lang string, item_text string, answer string")
    got = L.find_leaks(d, i, shard_words=40)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(k, j) for k in (1, 4, 6) for j in (10, 11)]
    assert got.where("doc_id = 1").first().spans[0].asDict() == {"first": 1, "last": 20}
    blocks = L.find_leaks(d, i, shard_words=40, most_items=1)
    assert sorted((r.doc_id, r.item_id) for r in blocks.collect()) == [(k, j) for k in (1, 4, 6) for j in (10, 11)]
    assert L.find_leaks(d.where("false"), i).count() == 0 and L.find_leaks(d, i.where("false")).count() == 0
