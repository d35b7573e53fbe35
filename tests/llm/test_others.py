import random

import pytest
from pyspark.sql import functions as F

from loomcast.llm import bpe, langid, quality, sampling
from loomcast.session import table

TEXTS = [
    "", "Hello world! It's 2024, isn't it?", "  leading  and trailing  ", "tabs\tand\nlines\r\n\n", "嘉宾藤灯花了160个月研究，绳索吊桥。", "ガラス工房の色は、ラジオ", "Привет, мир — №5", "naïve café ½ Ⅳ ﬁ é",
    "👩‍🚀🎧𝄞", "<|endoftext|>", "x" * 3000, "ab" * 600, "\u0000\u0001  　", "%<-@_^#)*#!)):$}", None,
]


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    rows = [(i, x, "clash") for i, x in enumerate(TEXTS)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, ids string")
    out = bpe.encode(df)
    got = {r.doc_id: r.ids for r in out.collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x, _ in rows}
    back = {r.doc_id: r.decoded for r in bpe.decode(out).collect()}
    assert back == {i: x or "" for i, x, _ in rows}
    assert bpe.encode(df.where("false")).count() == 0
    # With few frequent parts, or none, the others take the other way, and nothing else changes.
    for hot in (0, 3, 40):
        assert {r.doc_id: r.ids for r in bpe.encode(df, hot=hot).collect()} == got
    assert bpe.encode(df).count() == len(rows) + 3


def test_words_are_those_of_the_pattern():
    regex = pytest.importorskip("regex")
    blanks = "".join(map(chr, bpe.BLANKS))
    pattern = regex.compile(rf"'(?:{'|'.join(bpe.CONTRACTIONS)})| ?\p{{L}}+| ?\p{{N}}+| ?[^{blanks}\p{{L}}\p{{N}}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+")
    rng = random.Random(8)
    texts = ["".join(rng.choices(["'", " ", "  ", "\n", "s", "re", "ll", "t", "a", "9", "!", "é", "字", "\u3000", "'s", " '", "́"], k=rng.randrange(0, 25))) for _ in range(3000)] + TEXTS[:-1]
    import numpy as np

    whole = "".join(texts)
    first = np.zeros(len(whole), dtype=bool)
    at = np.cumsum([0, *map(len, texts)])[:-1]
    first[[a for a, t in zip(at, texts) if t]] = True
    starts = set(np.flatnonzero(bpe.word_starts(np.frombuffer(whole.encode("utf-32-le"), dtype="<u4"), first)).tolist())
    assert starts == {a + m.start() for a, t in zip(at.tolist(), texts) for m in pattern.finditer(t)}


def test_heap_equals_fold(spark):
    words = [x for x in TEXTS if x and len(x) < 60]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in df.select("w", bpe.encode_bytes(F.decode(F.encode("w", "UTF-8"), "ISO-8859-1")).alias("i")).collect():
        assert r.i == bpe.merge_bytes(r.w.encode())


@pytest.fixture(scope="module")
def model(spark, sf):
    return langid.fitted(table(spark, sf, "lang_samples"))


def test_held_out_accuracy(spark, sf):
    rows = sorted((r.lang, r.text) for r in table(spark, sf, "lang_samples").collect())
    m = langid.fit(rows[::2])
    right = sum([x[0] for x in langid.languages_of(m, t)] == [lang] for lang, t in rows[1::2])
    assert right >= 0.97 * len(rows[1::2])


def test_segmentations_are_summed():
    import numpy as np

    one = lambda x: np.array([x])
    m = langid.Model(["x"], {"▁a": one(0.5), "b": one(0.25), "▁ab": one(0.125), "▁": one(0.1), "a": one(0.2)}, 3, one(1e-7))
    assert np.isclose(np.exp(m.word("▁ab"))[0], 0.5 * 0.25 + 0.125 + 0.1 * 0.2 * 0.25)


def test_labels_and_mixtures(spark, model):
    en = "We talk about the history of the old mills and why it still matters to them. "
    fr = "Nous parlons ici de la seconde vie des vieux moulins et de leur histoire. "
    rows = [("1", en, "English"), ("2", en, "fr"), ("3", en + fr, "en"), ("4", en, "und"), ("5", "", None), ("6", None, "en"), ("7", "Ok. No.", "de"), ("8", en * 4000, "en_GB"), ("9", en, "mul")]
    df = spark.createDataFrame(rows, "k string, t string, language string")
    got = {(r.k, r.lang_code) for r in langid.mislabelled(langid.segments(df, model, ["k"], "t", "language")).collect()}
    assert got == {("2", "en"), ("3", "en"), ("3", "fr"), ("4", "en"), ("9", "en")}


def test_segments_have_places_and_confidence(spark, model):
    en = "We talk about the history of the old mills and why it still matters to them. "
    fr = "Nous parlons ici de la seconde vie des vieux moulins et de leur histoire. "
    text = "Hm. " + en * 2 + fr + "Ah! " + en
    got = langid.segments_of(model, text)
    assert [(x[2], x[4]) for x in got] == [("en", 2), ("fr", 1), ("en", 1)] and all(x[3] >= langid.LEAST_CONFIDENCE for x in got)
    assert got[0][0] == 0 and "Nous parlons" in text[got[1][0] : got[1][1]] and text[got[1][0] : got[1][1]].strip().endswith("Ah") and all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    df = spark.createDataFrame([("1", text, "en"), ("2", None, "en"), ("3", "", None)], "k string, t string, language string")
    rows = langid.segments(df, model, ["k"], "t", "language").collect()
    assert [(r.k, r.segment, r.lang_code, r.n_languages) for r in sorted(rows, key=lambda r: r.segment)] == [("1", 0, "en", 2), ("1", 1, "fr", 2), ("1", 2, "en", 2)]


def test_long_words_are_summed_whole():
    import numpy as np

    one = lambda *x: np.array(x)
    m = langid.Model(["x", "y"], {"a": one(0.5, 0.1), "aa": one(0.25, 0.02)}, 2, one(1e-7, 1e-7))
    for n in (30, 33, 70, 3000):
        f = [one(0.0, 0.0), np.log(one(0.5, 0.1))]
        for _ in range(n - 1):
            f.append(np.logaddexp(f[-1] + np.log(one(0.5, 0.1)), f[-2] + np.log(one(0.25, 0.02))))
        assert np.allclose(m.word("a" * n), f[n])


def test_sampling_counts_are_exact(spark, sf):
    items, targets = table(spark, sf, "audio_urls"), table(spark, sf, "sample_targets")
    want = {(r.plan_id, r.target_id): r.drawn for r in sampling.report(items, targets).collect()}
    drawn = sampling.draw(items, targets)
    got = {(r.plan_id, r.target_id): (r.n, r.d) for r in drawn.groupBy("plan_id", "target_id").agg(F.count("*").alias("n"), F.count_distinct("item").alias("d")).collect()}
    assert {k: v for k, v in want.items() if v} == {k: v[0] for k, v in got.items()} and all(a == b for a, b in got.values())


def test_sampling_edges(spark):
    items = spark.createDataFrame([(f"i{k}", "c", "s", "en") for k in range(100)] + [("i1", "c", "s", "en"), (None, "c", "s", "en"), ("n", None, None, None)], "source_id string, category string, source string, language string")
    targets = spark.createDataFrame([(1, 1, 5000, "c", "*", "*", 5000, 1), (1, 2, 5000, "*", "*", "fr", 1000, 2), (1, 3, 5000, "*", "*", "*", 4000, 1)], "plan_id long, target_id long, sample_bp int, category string, source string, language string, share_bp int, min_rows int")
    r = {x.target_id: (x.needed, x.observed, x.drawn, x.deficit) for x in sampling.report(items, targets).collect()}
    assert r == {1: (25, 100, 25, 0), 2: (5, 0, 0, 5), 3: (20, 101, 20, 0)}
    assert sampling.draw(items, targets).count() == 45
    assert sampling.report(items.where("false"), targets).where("deficit > 0").count() == 3


def test_kinds(spark, sf):
    common, pairs = quality.common_words(table(spark, sf, "common_words")), quality.sample_pairs(table(spark, sf, "lang_samples"))
    prose = "We talk about the history of the mills, and why it still matters to all of you. There were many questions about it."
    cases = {
        "prose": [prose, "\n".join([prose] * 3), "Anna: " + prose + "\nBen: " + prose, prose + "\n\n- the mill\n- the well\n\n" + prose, prose.lower().replace(".", "").replace(",", ""), "<p>" + prose + "</p>"],
        "list": ["Things:\n" + "\n".join(f"- the thing of day {i}" for i in range(9)), "\n".join(f"{i}. the rules of {w}" for i, w in enumerate("gardens wells mills kites trains radios clubs".split())), ", ".join(f"the {a} of {b}" for a, b in zip("smell map rules craft price sound weather song".split(), "gardens wells mills kites trains radios clubs lamps".split()))],
        "table": ["\n".join("\t".join(["ok", "12:30", "Ann", "7"]) for _ in range(6)), "| a | b | c |\n| --- | --- | --- |\n" + "| 1 | 2 | 3 |\n" * 4, "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>"],
        "junk": ["woiw wqwek pfx xaxrc xzsd vjsc szwv vuco qxqu xwvv iwmk zxqp vvuq", "%<-@_^#)*#!)):$}:@:*]![/+#" * 3, "aB3/" * 80, "\n".join(f"[{i}] dbg buf=0x{i:04x} q=2 drop=1" for i in range(9)), "44 cc c6 bb 62 03 cb 4e bc 3c e0 04 7b 8c c0 f8 " * 3, "Limdra " * 40],
        None: ["", "  \n ", None],
    }
    rows = [(k, t, "clash") for k, ts in cases.items() for t in ts]
    df = spark.createDataFrame([(i, t, c) for i, (_, t, c) in enumerate(rows)], "doc_id long, text string, text_kind string")
    got = {r.doc_id: r.text_kind for r in quality.describe(df, common, pairs).collect()}
    assert [(rows[i][1], k) for i, k in sorted(got.items()) if k != rows[i][0]] == []
    assert quality.describe(df.where("false"), common, pairs).count() == 0


def test_loops_are_junk_and_prose_is_prose_at_any_length(spark, sf):
    common, pairs = quality.common_words(table(spark, sf, "common_words")), quality.sample_pairs(table(spark, sf, "lang_samples"))
    words = "the mill and of a well that was in it for you with kite garden radio club lamp train song map weather craft price sound rule smell".split()
    rng = random.Random(3)
    block = lambda n: " ".join(f"{rng.choice(words)} {rng.choice(words)}{rng.randint(0, 40) or '.'}" for _ in range(n // 2)) + ". "
    loops = [block(60) * 80, block(60) * 90, block(60) * 400, block(1500) * 20]
    long_prose = table(spark, "/root/testdata/sf0.1", "documents").where("doc_id = 8225").first().text
    df = spark.createDataFrame(list(enumerate([*loops, long_prose])), "doc_id long, text string")
    got = {r.doc_id: (r.text_kind, r.n_words, r.duplicate_gram_share) for r in quality.describe(df, common, pairs).collect()}
    assert [got[i][0] for i in range(5)] == ["junk"] * 4 + ["prose"]
    assert got[1][1] > 5000 and got[4][1] > 5000 and got[4][2] > 0.8


def test_characters_of_the_dominant_gram(spark):
    long = "extraordinarily incomprehensible internationalisation"
    texts = {f"{long} a b {long} c d": 2 * 51 / (2 * 51 + 4), "a b a b a z incomprehensible": 5 / 22, "x x x x incomprehensible": 4 / 20, "one two": 0.0, "": None}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r.top_gram_char_share for r in quality.describe(df, [], []).orderBy("doc_id").collect()]
    assert got == [w if w is None else pytest.approx(w) for w in texts.values()]


def test_sampling_accepts_by_probability(spark, monkeypatch):
    items = spark.createDataFrame([(f"i{k}", "c", "s", "en") for k in range(3000)], "source_id string, category string, source string, language string")
    targets = spark.createDataFrame([(1, 1, 1000, "c", "*", "*", 10000, 1)], "plan_id long, target_id long, sample_bp int, category string, source string, language string, share_bp int, min_rows int")
    whole = sorted(r.item for r in sampling.draw(items, targets).collect())
    assert len(whole) == 300 <= sampling.candidates(items, targets)[0].count() < 500
    monkeypatch.setattr(sampling, "OVERSAMPLING", 0.5)
    monkeypatch.setattr(sampling, "SLACK", 0)
    assert sampling.candidates(items, targets)[0].count() == 3000
    assert sorted(r.item for r in sampling.draw(items, targets).collect()) == whole
