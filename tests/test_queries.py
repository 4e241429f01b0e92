"""Every query of the library against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import same

from peakframe import plans, registry  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, data, name):
    same(spark, data, registry.QUERIES[name], registry.ORACLE_SQL[name])


def running(files, most):
    """Chunks by a running sum in plain Python."""
    want, state = {}, {}
    for r, f, n in files:
        chunk, held = state.get(r, (0, None))
        if held is not None and held + (n or 0) > most:
            chunk, held = chunk + 1, 0
        state[r] = (chunk, (held or 0) + (n or 0))
        want[f] = chunk
    return want


@pytest.mark.parametrize("span", [1, 3, 50, 1000])
def test_size_capped_chunks(spark, span):
    """Against a running sum: keys over several spans, empty files, files over the limit, null keys and sizes."""
    import random

    from peakframe.operators.capped import capped

    rng = random.Random(5)
    files = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([0, 0, 1, 3, 5, 9, 10, 11, 25, None])) for i in range(130)] + [("c", 400, 30)]
    df = spark.createDataFrame(files, "release string, file long, bytes long")
    assert {x["file"]: x["chunk"] for x in capped(df, ["release"], ["file"], "bytes", 10, span, branch=4).collect()} == running(files, 10)
    assert capped(df.limit(0), ["release"], ["file"], "bytes", 10, span).count() == 0


def test_composed_steps_are_a_running_sum():
    """Stretches composed in any grouping, for every state that can reach them; steps stay few."""
    import random

    import numpy as np

    from peakframe.operators import capped as K

    rng = random.Random(7)
    for _ in range(300):
        most = rng.choice([5, 10, 40])
        sizes = [[rng.choice([0, 0, 1, 1, 2, 3, 6, most, most + 3]) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 7))]
        parts = [K._steps(np.concatenate([[0], np.cumsum(x)]), most) for x in sizes]
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [parts[k].then(parts[k + 1], most)]
        for held in [-1, *range(most + 1)]:
            now, opened = held, 0
            for n in (n for x in sizes for n in x):
                if now < 0 or now + n > most:
                    now, opened = 0, opened + 1
                now += n
            assert parts[0].at(held, most) == (now, opened)
            assert parts[0].only(held, most).at(held, most) == (now, opened)
    few = [K._steps(np.arange(1001), 100) for _ in range(3)]
    assert len(few[0].then(few[1], 100).then(few[2], 100).reach) <= 101


def test_small_files_under_a_large_cap_give_single_steps(spark):
    """While all before a span fits into one chunk, one state alone reaches it: its row has one step, not one for each file."""
    from peakframe.operators import capped as K

    sizes, seen = [], K.Steps.only
    df = spark.range(2000).selectExpr("'r' AS release", "id AS file", "1L AS bytes")
    got = K.capped(df, ["release"], ["file"], "bytes", 10**9, 100, branch=3)
    assert got.select("chunk").distinct().collect()[0][0] == 0 and got.count() == 2000
    steps = K._steps(K._sums(df.toPandas()["bytes"]), 10**9)
    sizes = [len(steps.reach), len(seen(steps, 7, 10**9).reach)]
    assert sizes == [2000, 1]
