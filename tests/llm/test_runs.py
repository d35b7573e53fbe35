import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from loomcast.llm import runs as R


def osa(a, b):
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=500, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_bounded_distance(a, b):
    assert R.within(a, b) == (osa(a, b) <= 2)


def cue(pos, text, start=None, track="t"):
    s = pos * 2.0 if start is None else start
    return (track, pos, s, s + 1.5, text)


def test_what_repeats():
    def same(a, b, **k):
        return R.repeats(cue(1, a), cue(2, b, **k))

    assert same("Hello there, <i>friend</i>!", "HELLO&nbsp;THERE FRIEND")
    assert same("we talk about wells", "we tlak abuot wells".replace("abuot", "about"))
    assert not same("Chapter 12 of the reading", "Chapter 13 of the reading")
    assert not same("one two three", "four five six")
    assert not same("", "") and not same("♪", "♪") and not same(None, None)
    assert same("hello world", "hello world", start=5.5) and not same("hello world", "hello world", start=5.6)
    assert not R.repeats(cue(1, "x y z"), cue(3, "x y z", start=3.0)) and not R.repeats(cue(1, "abc"), cue(2, "abc", track="u"))
    assert not R.repeats(("t", 1, None, None, "abc"), ("t", 2, None, None, "abc"))


def plain_runs(cues):
    out, now = [], []
    for c in cues:
        if now and R.repeats(now[-1], c):
            now.append(c)
        else:
            out += [(now[0][0], now[0][1], now[-1][1])] if len(now) > 1 else []
            now = [c]
    return out + ([(now[0][0], now[0][1], now[-1][1])] if len(now) > 1 else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["aaaa", "bbbb", ""]), max_size=14), st.lists(st.integers(0, 14), max_size=5))
def test_merge_is_associative(texts, cuts):
    cues = [cue(i, t) for i, t in enumerate(texts)]
    edges = sorted({0, len(cues), *[min(c, len(cues)) for c in cuts]})
    summaries, closed = [], []
    for a, b in zip(edges, edges[1:]):
        for kind, x in R._fold(iter(cues[a:b]), R.repeats):
            (closed if kind == "run" else summaries).append(x)
    random.Random(len(cuts)).random()
    while len(summaries) > 1:  # from the right: the other order than the operator's
        s, c = R.combine(summaries[-2], summaries[-1], R.repeats)
        summaries[-2:] = [s]
        closed += c
    for s in summaries:
        closed += [r for r in s[2:] if r]
    assert sorted((r[0], r[1], r[2]) for r in closed if r[5] > 1) == sorted(plain_runs(cues))


def test_hot_track_over_many_partitions(spark):
    rng = random.Random(1)
    at = dt.datetime(2025, 1, 1)
    rows = [("hot", i, i * 1.0, i + 0.9, rng.choice(["alpha alpha", "beta beta beta"]), at) for i in range(600)]
    rows += [("same", i, i * 1.0, i + 0.9, "one long run", at) for i in range(300)]
    rows += [(f"t{k}", 0, 0.0, 1.0, "alone", at) for k in range(20)] + [(None, 1, 0.0, 1.0, "x", at), ("n", 1, None, None, None, at)]
    late = [(t, p, s, e, x, at + dt.timedelta(days=1)) for t, p, s, e, x, _ in rows[::7]]
    df = spark.createDataFrame(rows + late, "track_id string, pos int, cue_start double, cue_end double, text string, ingested_at timestamp")
    got = sorted((r.track_id, r.first_pos, r.last_pos) for r in R.collapse(df, partitions=70).collect())
    assert got == sorted(plain_runs([r[:5] for r in sorted(rows, key=lambda r: (r[0] or "", r[1])) if r[0]]))
    one = R.collapse(df, partitions=70).where("track_id = 'same'").first()
    assert (one.n_cues, one.run_start, one.run_end) == (300, 0.0, 299.9)
    assert R.collapse(df.where("false")).count() == 0
