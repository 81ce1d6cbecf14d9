"""The latest data of all sensors before a time, against a plain loop."""

import random

import pytest

from tallybeam.plans import registry
from tallybeam.sources import frames

DAY = 86_400_000_000


def plain(asked, starts, runs, ifos, file_us, days, years=5):
    out = {}
    for before in asked:
        for run, a, b in sorted(runs, key=lambda r: -r[1]):
            for d in days:
                lo, hi = max(a, before - d * DAY), min(b, before)
                if b < before - years * 365 * DAY or before in out:
                    continue
                at = {i: [s for x, s in starts if x == i and lo <= s < hi] for i in ifos}
                good = [s for s in at[ifos[0]] if all(any(abs(s - o) < file_us for o in at[i]) for i in ifos[1:])]
                if good:
                    out[before] = (run, d, max(good) + file_us)
    return out


@pytest.mark.parametrize(("file_us", "n"), [(4_096_000_000, 40), (DAY // 2, 25), (3 * DAY, 20), (10_000, 150)])
def test_previous_end_by_a_plain_loop(spark, file_us, n):
    rng = random.Random(file_us)
    span = 400 * DAY if n < 100 else 2_000_000
    starts = [(i, rng.randrange(span) // 7 * 7 - DAY) for i in ("H1", "L1", "V1") for _ in range(n)]
    starts += [(i, s + rng.randrange(-3 * file_us // 2, 3 * file_us // 2)) for x, s in starts if x == "H1" for i in ("L1", "V1") if rng.random() < 0.6]
    starts += [("H1", s) for _, s in starts[: n // 4]] + [("L1", s + file_us - 1) for _, s in starts[:3]] + [("V1", s + file_us) for _, s in starts[:3]]
    runs = [("A", -2 * DAY, span // 3), ("B", span // 3, span // 3 + span // 50), ("C", span // 2, 2 * span)]
    asked = sorted({rng.randrange(-DAY, span + DAY) for _ in range(60)} | {s + d for _, s in starts[:8] for d in (0, 1, file_us, file_us - 1)} | {a + file_us // 2 for _, a, _ in runs})
    ask, have, known = (spark.createDataFrame(rows, kind) for rows, kind in (([(a,) for a in asked], "before_us long"), (starts, "ifo string, start_us long"), (runs, "run string, run_start long, run_end long")))
    for ifos in (["H1"], ["H1", "L1"], ["H1", "L1", "V1"]):
        want = plain(asked, starts, runs, ifos, file_us, (1, 7, 30, 90))
        rows = frames.previous_available_end(ask, have, known, ifos, file_us).collect()
        assert {r.before_us: (r.run, r.days, r.end_us) for r in rows} == want and len(rows) == len(want)
        assert want
    assert frames.previous_available_end(ask, have, known.limit(0), ["H1"], file_us).count() == 0


def test_no_pair_of_rows_is_compared_by_range_alone(spark, sf):
    plan = registry.queries()["a24_previous_available_end"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_file_keeps_two_neighbours_at_most_of_a_crowd(spark):
    rng = random.Random(5)
    files, others = [(rng.randrange(-300, 3_000),) for _ in range(60)], [(rng.randrange(-300, 3_000),) for _ in range(400)]
    found = frames._neighbours(spark.createDataFrame(files, "s long").distinct(), spark.createDataFrame(others, "o long").distinct(), 100).collect()
    times = [o for (o,) in others]
    want = {s: (max((o for o in times if s - 100 < o <= s), default=None), min((o for o in times if s <= o < s + 100), default=None)) for (s,) in files}
    assert {r.s: r.near for r in found} == {s: [o for o in x if o is not None] for s, x in want.items() if x != (None, None)}
