import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loomcast import cli
from loomcast.operators import leases as L
from loomcast.sources import sinks

NOW = dt.datetime(2026, 1, 1, 12, tzinfo=dt.UTC)
COLUMNS = "id long, url string, source string, artifact_kind string, job_key string, status string, claimed_by string, claimed_at string, lease_expires_at string, local_path string, downloaded_at string, file_format string, file_size long, content_hash string, category string, language string"


def queue(spark, *rows):
    base = {"url": "", "source": "s", "artifact_kind": "audio", "job_key": "", "status": "pending", "claimed_by": "", "claimed_at": "", "lease_expires_at": "", "local_path": "", "downloaded_at": "", "file_format": "", "file_size": 0, "content_hash": "", "category": "c", "language": "en"}
    return spark.createDataFrame([tuple({"id": i, **base, "url": f"u{i}", **r}.values()) for i, r in enumerate(rows)], COLUMNS)


def states(df):
    return {r.id: (r.status, r.claimed_by) for r in df.collect()}


def held(by="w", until="2026-01-01T13:00:00+00:00", **more):
    return {"status": "downloading", "claimed_by": by, "claimed_at": "x", "lease_expires_at": until, **more}


def test_claims_are_disjoint_and_expire_in_their_scope(spark):
    old = "2026-01-01T11:00:00+00:00"
    q = queue(spark, {}, {}, {}, held(until=old), held(until=old, source="other"), held(), held(until=None), {"status": "failed"})
    after, first = L.claim(q, NOW, "a", 60, 2, source="s")
    again, second = L.claim(after, NOW, "b", 60, 9, source="s")
    assert sorted(r.id for r in first.collect()) == [0, 1] and sorted(r.id for r in second.collect()) == [2, 3]
    assert states(again)[4] == ("downloading", "w") and states(again)[5] == ("downloading", "w") and states(again)[6] == ("downloading", "w") and states(again)[7] == ("failed", "")
    assert {r.lease_expires_at for r in first.collect()} == {"2026-01-01T12:01:00+00:00"}
    # Failed rows are claimed only when asked for; run-out leases come back all the same.
    retried, taken = L.claim(q, NOW, "r", 60, 9, "failed", source="s")
    assert [r.id for r in taken.collect()] == [7] and states(retried)[3] == ("pending", "")
    with pytest.raises(ValueError):
        L.claim(q, NOW, "a", 0, 2)
    assert L.claim(q.where("false"), NOW, "a", 60, 2)[0].count() == 0


def test_renewal_is_for_own_rows(spark):
    q = queue(spark, held("w"), held("v"), {"status": "done", "claimed_by": "w"})
    out = L.renew(q, NOW, "w", q.select("id"), 30)
    assert {r.id: r.lease_expires_at for r in out.collect()} == {0: "2026-01-01T12:00:30+00:00", 1: "2026-01-01T13:00:00+00:00", 2: ""}
    assert [L.heartbeat_s(x) for x in (1, 90, 7200)] == [1, 30, 60]


def test_transitions(spark):
    q = queue(spark, held(), held(job_key="k"), held(job_key="d", url="same"), held(job_key="d", url="same"))
    updates = spark.createDataFrame([("u0", "", "done", "p"), ("u1", "k", "failed", ""), ("same", "d", "done", "p"), ("u9", "z", "done", "p")], "url string, job_key string, status string, local_path string")
    out, wrong = L.transition(q, updates, NOW)
    assert states(out) == {0: ("done", ""), 1: ("failed", ""), 2: ("downloading", "w"), 3: ("downloading", "w")}
    assert sorted((r.job_key, r.n_rows) for r in wrong.collect()) == [("d", 2), ("z", 0)] and out.where("id = 0").first().downloaded_at == NOW.isoformat()


def test_contents_are_kept_once(spark):
    q = queue(spark, {"status": "done", "content_hash": "h1"}, held(), held(), held(), held(artifact_kind="video_bundle"), held(job_key="j", url="u1"))
    done = [(1, "u1", "h1"), (2, "u2", "h2"), (3, "u3", "h2"), (4, "u4", "h1")]
    finished = spark.createDataFrame([(s, u, f"p{s}", "mp3", 5, h) for s, u, h in done], "seq long, url string, local_path string, file_format string, file_size long, content_hash string")
    out, found = L.finalise(q, finished, NOW)
    assert {r.url: r.is_duplicate for r in found.collect()} == {"u1": True, "u2": False, "u3": True, "u4": False}
    assert {r.id: r.local_path for r in out.collect()} == {0: "", 1: "dup:h1", 2: "p2", 3: "dup:h2", 4: "p4", 5: ""} and states(out)[5] == ("downloading", "w")


def test_recovery_is_exact(spark):
    q = queue(spark, held(), held(language="de"), held("v"), held(job_key="k"))
    scope = L.scope("w", "s", "audio", language="en")
    same, n = L.recover(q, scope)
    assert n == 2 and states(same) == states(q)
    assert states(L.recover(q, scope, 2)[0]) == {0: ("pending", ""), 1: ("downloading", "w"), 2: ("downloading", "v"), 3: ("pending", "")}
    assert L.recover(q, L.scope("w", "s", "audio", ids=(1, 3), job_keys=["k"]))[1] == 1
    for bad in (lambda: L.recover(q, scope, 3), lambda: L.scope("", "s", "audio"), lambda: L.scope("w", "s", "audio", ids=(3, 1))):
        with pytest.raises(ValueError):
            bad()


def test_compare_and_swap(spark):
    q = queue(spark, {}, {"status": "done"}, {"content_hash": None})
    changes = spark.createDataFrame([(0, "pending", "", "x"), (1, "pending", "", "x"), (2, "pending", None, "x"), (7, "pending", "", "x")], "id long, old_status string, old_content_hash string, new_status string")
    out, found = L.compare_and_swap(q, changes, ["status", "content_hash"], ["status"])
    assert {r.id: r.outcome for r in found.collect()} == {0: "applied", 1: "stale", 2: "applied", 7: "missing"}
    assert {r.id: r.status for r in out.collect()} == {0: "x", 1: "done", 2: "x"}
    twice = L.compare_and_swap(q, changes.unionByName(changes.where("id = 0")), ["status"], ["status"])
    assert twice[1].where("id = 0").first().outcome == "ambiguous" and twice[0].where("id = 0").first().status == "pending"


def test_commands(spark, sf, tmp_path, capsys):
    def run(*argv):
        code = cli.main([str(x) for x in argv], spark)
        return code, json.loads(capsys.readouterr().out)

    versions = sinks.Versions(spark, str(tmp_path / "queue"))
    versions.write(queue(spark, {}, {}, held("w:1:x", until="2999-01-01T00:00:00+00:00")))
    assert run("claim", "--queue", tmp_path / "queue", "--worker", "a", "--limit", 1)[1]["version"] is None and versions.current() == 1
    code, out = run("claim", "--queue", tmp_path / "queue", "--worker", "a", "--limit", 1, "--apply")
    assert code == 0 and out["version"] == 2 and [r["id"] for r in out["claimed"]] == [0]
    assert run("recover", "--queue", tmp_path / "queue", "--claimed-by", "w:1:x", "--source", "s", "--kind", "audio", "--apply")[1] == {"matched": 1, "version": 3}
    assert states(versions.read()) == {0: ("downloading", "a"), 1: ("pending", ""), 2: ("pending", "")}
    for report in cli.VIEWS:
        assert run("view", report, "--tables", sf)[1]
    assert run("view", "id", "7", "--tables", sf)[1][0]["id"] == 7 and {r["source"] for r in run("view", "source", "youtube", "--tables", sf)[1]} == {"youtube"}
    assert run("view", "month", "2022-03", "--tables", sf)[0] == 0 and run("view", "since", "2024", "--tables", sf)[0] == 0
    assert run("doctor", "--tables", sf)[0] == 0 and run("stats", "--tables", sf)[1]["status_rollup"] and run("audit", "coverage", "--tables", sf)[1]["metadata_coverage"]
    assert run("discover", "--tables", sf, "--stats")[1] and len(run("discover", "--tables", sf, "--limit", 3)[1]) == 3 and run("manifest", "items", "--tables", sf)[1]["items"] > 0
    n = run("fix-meta", "--tables", sf, "--target", tmp_path / "meta", "--apply")[1]["missing"]
    assert n > 0 and run("fix-meta", "--tables", sf, "--target", tmp_path / "meta", "--apply")[1] == {"missing": 0, "written": 0}
    spark.read.parquet(f"{sf}/audio_urls.parquet").write.parquet(str(tmp_path / "in"))
    got = run("collect", "--incoming", tmp_path / "in", "--target", tmp_path / "out", "--checkpoint", tmp_path / "ck")[1]
    assert got["rounds"] == 1 and 0 < got["rows"] <= spark.read.parquet(str(tmp_path / "in")).select(F.col("url")).distinct().count()
