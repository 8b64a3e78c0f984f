"""WIN-04 against a loop over each agent's reports."""

import datetime as dt
import random
import re

import pytest

from tidewatch.operators import inventory as INV

SCHEMA = "uuid string, partition int, offset long, timestamp timestamp, os_ver string, extra string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def brute(rows):
    out = []
    for agent in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == agent), key=lambda r: (r[3], r[2], r[4] is not None, r[4] or ""))
        for a, b in zip(own, own[1:], strict=False):
            if a[4] is not None and b[4] is not None and a[4] != b[4]:
                out.append((agent, b[2], a[4], b[4]))
    return sorted(out, key=str)


@pytest.mark.parametrize("spread", [40, 4000, 400_000, 40_000_000])
def test_equals_loop(spark, spread):
    """A hot agent with a third of the reports, equal times, missing systems, spans from seconds to months."""
    rng = random.Random(spread)
    start = dt.datetime(2024, 1, 31, 23, 59, 30)
    rows = [(("hot" if i % 3 == 0 else f"a{rng.randrange(9)}"), rng.randrange(3), i, start + dt.timedelta(seconds=rng.randrange(spread)),
             rng.choice(["w", "w", "w", "u", "c", None])) for i in range(600)]
    rows += [("same", 0, 7, start, os) for os in ("b", "a", None)] + [("one", 0, 1, start, "w")]
    out = INV.os_transitions(frame(spark, rows))
    assert out.columns == ["uuid", "offset", "old", "new"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)


def test_empty(spark):
    assert INV.os_transitions(frame(spark, [])).count() == 0


def test_no_join_and_no_window_over_an_agents_reports(spark):
    plan = INV.os_transitions(frame(spark, []))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    by = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert len(by) == 3 and sum("span" in b for b in by) == 2
    alone = plan.split("\n")
    depth = next(i for i, l in enumerate(alone) if "windowspecdefinition" in l and "span" not in l)
    below = [l for l in alone[depth + 1:] if "Aggregate" in l or "LocalRelation" in l]
    assert "Aggregate" in below[0] and "Aggregate" in below[1]     # days are summed up from minutes
