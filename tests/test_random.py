"""Random event sets against a pure-Python brute force of the whole chain."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from conftest import T0
from liftlens.operators import window_checkouts
from liftlens.plans.chain import build_tables


def rha(x, digits):
    """Python model of half-away rounding of the scaled double."""
    if x is None:
        return None
    scale = float(10 ** digits)
    scaled = Decimal(repr(x * scale)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    return float(scaled) / scale


def random_events(seed, n_users=12, n_events=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n_events):
        u = rng.choice([f"u{j}" for j in range(n_users)] + [None])
        t = None if rng.random() < 0.03 else T0 + dt.timedelta(
            hours=rng.randint(0, 24 * 20), microseconds=rng.choice([0, 0, 1, 999999]))
        country = rng.choice(["IN", "US", "DE", None])
        device = rng.choice(["mobile", "desktop"])
        if rng.random() < 0.45:
            key = rng.choice(["a", "b", None])
            variant = rng.choice(["control", "treatment", "treatment", None, "other"])
            rows.append((f"e{i:04d}", u, "s", "experiment_exposure", t, key, variant,
                         country, device, None))
        else:
            rev = rng.choice([None, 0.0, round(rng.uniform(1, 99), 2), 1.005])
            name = rng.choice(["checkout_completed", "checkout_completed", "page_view"])
            rows.append((f"c{i:04d}", u, "s", name, t, None, None, country, device, rev))
            if rng.random() < 0.1:  # exact copy
                rows.append(rows[-1])
    return rows


def brute_conversions(rows, lookback=7):
    best = {}
    for r in rows:
        if r[3] != "experiment_exposure" or r[5] is None or r[6] is None:
            continue
        key = (r[5], r[1])
        rank = (r[4] is None, r[4] or T0, r[0])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    out = {}
    for (k, u), (_, e) in best.items():
        hits = [c for c in rows if c[3] == "checkout_completed" and u is not None
                and c[1] == u and e[4] is not None and c[4] is not None
                and e[4] <= c[4] < e[4] + dt.timedelta(days=lookback)]
        first = min((c[4] for c in hits), default=None)
        total = float(sum(Decimal(repr(c[9] or 0.0)) for c in hits))
        out[(k, u)] = dict(variant=e[6], country=e[7], device=e[8], ts=e[4],
                           conv=first, rev=rha(total, 2), hits=len(hits))
    return out


def brute_summary(conv):
    groups = {}
    for (k, _), c in conv.items():
        g = groups.setdefault((k, c["variant"]), [0, 0, 0])
        g[0] += 1
        g[1] += c["conv"] is not None
        g[2] += round(c["rev"] * 100)
    out = {}
    for (k, v), (n, cv, cents) in groups.items():
        rev = cents / 100.0
        out[(k, v)] = (n, cv, rha(cv / n, 4), rha(rev, 2), rha(rev / n, 2))
    lifted = {}
    for (k, v), m in out.items():
        c = out.get((k, "control"))
        if c is None:
            lifts = (None, None, None)
        else:
            rel = None if c[2] == 0 else rha((m[2] / c[2] - 1.0) * 100.0, 2)
            lifts = (rha(m[2] - c[2], 4), rel, rha(m[4] - c[4], 2))
        lifted[(k, v)] = m + lifts
    return lifted


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(raw, seed):
    rows = random_events(seed)
    t = build_tables(raw(rows))
    expected = brute_conversions(rows)
    got = {(r.experiment_key, r.user_id): r for r in t.conversions.collect()}
    assert set(got) == set(expected)
    for key, e in expected.items():
        g = got[key]
        assert (g.variant, g.country, g.device_type, g.exposure_ts) == (
            e["variant"], e["country"], e["device"], e["ts"]), key
        assert g.conversion_ts == e["conv"] and g.revenue == e["rev"], key

    summary = {(r.experiment_key, r.variant): tuple(r)[2:] for r in t.summary.collect()}
    assert summary == brute_summary(expected)

    counts = {(r.experiment_key, r.user_id): r.checkouts
              for r in window_checkouts(t.exposures, t.staged).collect()}
    assert counts == {k: e["hits"] for k, e in expected.items() if e["hits"]}
