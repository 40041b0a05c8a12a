"""The chain from draft to finished cues, by hand, and report objects."""

import json
import os

import pytest

from cuelake.operators import finishing, rules, speech
from cuelake.plans import registry
from cuelake.sources import reports, shared

DATA = "/root/testdata/sf0.001"

CUES = "title_id string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"
SPOKEN = "title_id string, seg_no bigint, start_ms bigint, end_ms bigint"


def finish(spark, cues, spoken=(), credit="Credit", **more):
    draft = spark.createDataFrame([("t", k + 1, k + 1, *c) for k, c in enumerate(cues)], CUES)
    heard = spark.createDataFrame([("t", k + 1, a, b) for k, (a, b) in enumerate(spoken)], SPOKEN)
    return finishing.finish(draft, heard, credit, **more).orderBy("pos").collect()


def test_trimmed_ends_reach_the_extension(spark):
    # a lingers for 1.9 s after speech: trimmed to 2250; the gap that this opens is over a second, so it stays; b is fast and gets time from its own new end
    a, b, credit = finish(spark, [(0, 3900, "Rustig."), (9000, 9900, "[NM] " + "woord " * 4 + "eind")], [(100, 2000), (9000, 9900)])
    assert (a["end_ms"], a["trim_ms"], a["closed"], a["extended"]) == (2250, 1650, False, False)
    assert b["extended"] and b["end_ms"] == 9000 + 28 * 1000 // 12.5
    assert (credit["text"], credit["start_ms"], credit["idx"], credit["source_count"]) == ("Credit", b["end_ms"] + 3000, 3, None)


def test_trim_then_close(spark):
    # trimmed by 450 ms before a cue that follows closely: the gap is under a second and is closed again
    a, _, _ = finish(spark, [(0, 3000, "Rustig."), (3200, 5000, "[NM] Ook rustig.")], [(100, 2300), (3200, 5000)])
    assert (a["trim_ms"], a["closed"], a["end_ms"]) == (450, True, 3080)


def test_markers_merge_and_balance(spark):
    rows = finish(spark, [(0, 2000, "Een regel die hier begint!"), (2200, 4000, "en die hier dan weer verder gaat…"), (4200, 6000, "[SC] Nee."), (8000, 9000, "  ")], credit="verder")
    assert [r["source_count"] for r in rows][:1] == [2] and all("[" not in r["text"] and "!" not in r["text"] and "…" not in r["text"] for r in rows)
    assert rows[-1]["text"] == "verder"


def test_last_cue_has_the_credit(spark):
    assert [r["text"] for r in finish(spark, [(0, 2000, "CREDIT.")], credit="credit")] == ["CREDIT."]
    assert finish(spark, [(0, 2000, " ")]) == []
    assert finish(spark, []) == []


def test_lingering_falls(spark):
    cues = [(k * 6000, k * 6000 + 3400, f"[NM] Zin {k} van allen") for k in range(20)]
    spoken = [(k * 6000, k * 6000 + 1500) for k in range(20)]
    done = finish(spark, cues, spoken)[:-1]
    late = sum(r["end_ms"] - (k * 6000 + 1500) > 500 for k, r in enumerate(done))
    assert late == 0 and len(done) == 20


def test_summary(spark):
    draft = spark.createDataFrame([("t", 1, 1, 0, 2000, "Een;"), ("t", 2, 2, 2200, 4000, "twee"), ("u", 1, 1, 0, 100, "x" * 60)], CUES)
    done = spark.createDataFrame(finishing.finish(draft, spark.createDataFrame([], SPOKEN), "Credit").collect(), CUES + ", source_count int, trim_ms bigint, closed boolean, extended boolean, balance string")
    got = {r["title_id"]: r for r in finishing.summary(done).collect()}
    assert (got["t"]["source_cues"], got["t"]["output_cues"], got["t"]["merges"], got["t"]["ratio_permille"], got["t"]["total_cues"], got["t"]["valid"]) == (2, 1, 1, 500, 2, True)
    assert not got["u"]["valid"]


def test_report_objects(spark, tmp_path):
    own = spark.createDataFrame([("t", 1, 1, 0, 3900, "Rustig."), ("t", 2, 2, 9000, 9900, "x;"), ("u", 1, 1, 0, 900, "y")], CUES)
    spoken = spark.createDataFrame([("t", 1, 100, 2000)], SPOKEN)
    reports.write(reports.trim(speech.trim(own, spoken), {"fps": 25}), str(tmp_path / "trim"))
    raw = json.loads(next((tmp_path / "trim" / "title_id=t").glob("part-*")).read_text())
    assert raw["settings"] == {"fps": 25} and raw["summary"] == {"total_cues": 2, "full_trims": 1, "partial_trims": 0, "skipped": 1, "total_trim_ms": 1650, "skip_reasons": {"no_transition": 1}}
    assert raw["trims"] == [{"cue_num": 1, "old_end": 3900, "new_end": 2250, "action": "trim", "trim_ms": 1650, "method": "full"}]
    back = {r["title_id"]: r for r in reports.read(spark, str(tmp_path / "trim"), "trim").collect()}
    assert back["u"]["trims"] == [] and back["u"]["total_cues"] == 1 and back["t"]["trims"][0]["new_end"] == 2250
    judged = {r["title_id"]: json.loads(r["value"]) for r in reports.validation(own, rules.violations(own)).collect()}
    assert not judged["t"]["summary"]["valid"] and judged["t"]["summary"]["error_count"] == sum(x["severity"] == "error" for x in judged["t"]["findings"])
    assert "semicolon" in [x["code"] for x in judged["t"]["findings"]]


def test_timing_report(spark):
    analyzed = spark.createDataFrame([("t", 1, 7, -900, 100), ("t", 2, 8, 50, None), ("u", 1, 1, None, None)], "title_id string, pos bigint, idx int, end_delta_ms bigint, start_delta_ms bigint")
    issues = spark.createDataFrame([("t", 1, "lingers_after_speech", "medium"), ("t", 1, "early_start", "low")], "title_id string, pos bigint, type string, severity string")
    got = {r["title_id"]: json.loads(r["value"]) for r in reports.timing(analyzed, issues, {"threshold_ms": 500}).collect()}
    s = got["t"]["summary"]
    assert (s["cues_analyzed"], s["cues_flagged"], s["high"], s["medium"], s["low"], s["anticipation_ideal"], s["end_delta_avg_ms"], s["start_delta_avg_ms"]) == (2, 1, 0, 1, 0, 1, -425, 100)
    assert got["t"]["flagged"] == [{"cue_num": 7, "issues": [{"type": "early_start", "severity": "low"}, {"type": "lingers_after_speech", "severity": "medium"}], "end_delta_ms": -900, "start_delta_ms": 100}]
    assert got["u"]["summary"]["cues_analyzed"] == 1 and got["u"]["flagged"] == [] and "end_delta_avg_ms" not in got["u"]["summary"]


def test_reports_in_lines(spark, tmp_path):
    # many titles make as many lines, not files; titles come back as they are
    titles = [None, "", "}", *(f"{k} a+b/é%20\n\"}}" for k in range(27))]
    own = spark.createDataFrame([(t, 2, 2, 9000, 9900, "x;") for t in titles] + [(t, 1, 1, 0, 3900, "Rustig.") for t in titles[:20]], CUES)
    objects = reports.trim(speech.trim(own, spark.createDataFrame([(t, 1, 100, 2000) for t in titles], SPOKEN)), {"fps": 25}).coalesce(2)
    reports.write_lines(objects, str(tmp_path / "trim"))
    assert len(list((tmp_path / "trim").rglob("part-*"))) <= 2
    back = {r["title_id"]: r for r in reports.read_lines(spark, str(tmp_path / "trim"), "trim").collect()}
    assert set(back) == set(titles) and [len(back[t]["trims"]) for t in titles] == [1] * 20 + [0] * 10
    assert back[titles[4]]["trims"][0].asDict() == {"cue_num": 1, "old_end": 3900, "new_end": 2250, "action": "trim", "trim_ms": 1650, "method": "full"}
    assert back[titles[4]]["skip_reasons"] == {"no_transition": 1} and back[titles[29]]["total_cues"] == 1
    first = json.loads(next((tmp_path / "trim").rglob("part-*")).read_text().split("\n")[0])
    assert list(first) == ["title_id", "settings", "summary", "trims"]
    with pytest.raises(Exception, match="exist"):
        reports.write_lines(objects, str(tmp_path / "trim"))


def test_a_report_is_one_pass(spark):
    # cues that were trimmed, counts and reasons come of the same rows; before, each was worked out from the frames again and joined
    rows = [("t", 2, 2, 5000, "trim", None, 4000, 1000, "full"), ("t", 1, 1, 3000, "partial_trim", None, 2500, 500, "partial"), ("t", 3, 3, 7000, "skip", "short", None, 0, None), ("t", 4, 4, 9000, "skip", None, None, 0, None), ("u", 1, 1, 900, "trim", None, 400, 500, "full")]
    decisions = spark.createDataFrame(rows, "title_id string, pos bigint, idx int, old_end_ms bigint, action string, reason string, new_end_ms bigint, trim_ms bigint, method string")
    made = reports.trim(decisions)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r["title_id"]: json.loads(r["value"]) for r in made.collect()}
    assert got["t"]["summary"] == {"total_cues": 4, "full_trims": 1, "partial_trims": 1, "skipped": 2, "total_trim_ms": 1500, "skip_reasons": {"short": 1}}
    assert [x["cue_num"] for x in got["t"]["trims"]] == [1, 2] and "skip_reasons" not in got["u"]["summary"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_files_of_reports_dont_grow_with_titles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "new_folder", lambda s, name: str(tmp_path / name))
    titles = registry.queries()["report_objects"](spark, DATA).select("title_id").distinct().count()
    for kind in ("trim", "extension"):
        assert 0 < len(list((tmp_path / "reports" / kind).rglob("part-*"))) < titles
