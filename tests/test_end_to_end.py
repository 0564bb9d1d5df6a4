"""A run that dies goes on where it stopped, and keeps no cache."""

from __future__ import annotations

from dataclasses import replace

import pytest

from sparkmart import adapter, end_to_end
from sparkmart.end_to_end import run_end_to_end
from sparkmart.plans import QUERIES, load_all

SF = "/root/testdata/sf0.001"


def test_killed_run_resumes(spark, tmp_path, monkeypatch):
    load_all()
    calls = []

    def watch(owner, name):
        real = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, **k: (calls.append(name), real(*a, **k))[1])

    for owner, name in ((end_to_end.feat, "customer_features"), (end_to_end.M, "run_kmeans"),
                        (end_to_end.M, "run_decision_tree"), (end_to_end.R, "fp_growth")):
        watch(owner, name)
    frames = {}
    real_run = run_end_to_end

    def keep(sp, *args, **kwargs):
        frames["args"] = args[:3]
        frames["cfg"] = args[4] if len(args) > 4 else kwargs.get("cfg")
        raise LookupError

    import sparkmart.plans.q_end_to_end as q

    monkeypatch.setattr(q, "run_end_to_end", keep)
    with pytest.raises(LookupError):
        QUERIES["end_to_end_stage_rows"](spark, SF)
    inputs, cfg, base = frames["args"], replace(frames["cfg"]), str(tmp_path)
    go = lambda **k: real_run(spark, *inputs, base, cfg, **k)
    steps = ["customer_features", "run_kmeans", "run_decision_tree", "fp_growth"]

    _, whole = go()
    assert calls == steps and all(n > 0 for n in list(whole.values())[:3])
    assert not any(df.is_cached for df in inputs)

    calls.clear()
    with monkeypatch.context() as m:
        def dies(*a, **k):
            raise RuntimeError("lost")

        m.setattr(end_to_end.M, "run_decision_tree", dies)
        with pytest.raises(RuntimeError):
            go()  # a new run over the finished one
    assert calls == steps[:2] and not any(df.is_cached for df in inputs)

    calls.clear()
    timings, again = go(resume=True)
    assert calls == steps[2:] and again == whole
    assert [name for name, _ in timings] == ["load", "classification", "association"]

    calls.clear()
    assert go(resume=True) == ([], whole) and calls == []
    cfg.k += 1  # other settings: nothing that is there counts
    _, other = go(resume=True)
    assert calls == steps and other == whole
