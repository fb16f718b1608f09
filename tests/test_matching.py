"""The matcher against a plain loop over all pairs."""

import datetime as dt
import math
import random

import pytest

from wayfold.operators import matching as M

V = "event_id long, ts timestamp, viaje_id long, vehiculo_id long, num_plazas long, latitud double, longitud double, latitud_final double, longitud_final double"
U = "event_id long, ts timestamp, viaje_id long, cliente_id long, latitud double, longitud double, rating double, metodo_pago string"
START = dt.datetime(2024, 1, 1)


def data(seed, pings=60, trips=3, minutes=4, area=0.04, hot=0.0):
    rnd = random.Random(seed)

    def place():
        return 39.45 + rnd.uniform(0, area), -0.40 + rnd.uniform(0, area)

    def trip():
        return 1 if rnd.random() < hot else rnd.randint(1, trips)

    vs = [(k, START + dt.timedelta(seconds=rnd.randrange(60 * minutes)), trip(), rnd.randint(1, 6), rnd.randint(0, 3), *place(), *place()) for k in range(pings)]
    us = [(k, START + dt.timedelta(seconds=rnd.randrange(60 * minutes)), trip(), rnd.randint(1, 25), *place(), 5.0, "Tarjeta") for k in range(pings * 2)]
    return vs, us


def km(a, b, c, d):
    """Ellipsoidal distance by direct iteration until nothing changes."""
    f = 1 / 298.257223563
    u, w, far = math.atan((1 - f) * math.tan(math.radians(a))), math.atan((1 - f) * math.tan(math.radians(c))), math.radians(d - b)
    lam = far
    for _ in range(50):
        sin = math.hypot(math.cos(w) * math.sin(lam), math.cos(u) * math.sin(w) - math.sin(u) * math.cos(w) * math.cos(lam))
        if sin == 0:
            return 0.0
        cos = math.sin(u) * math.sin(w) + math.cos(u) * math.cos(w) * math.cos(lam)
        sigma, az = math.atan2(sin, cos), math.cos(u) * math.cos(w) * math.sin(lam) / sin
        sq = 1 - az * az
        mid = cos - 2 * math.sin(u) * math.sin(w) / sq
        k = f / 16 * sq * (4 + f * (4 - 3 * sq))
        lam = far + (1 - k) * f * az * (sigma + k * sin * (mid + k * cos * (2 * mid * mid - 1)))
    k = sq * (1 / (1 - f) ** 2 - 1)
    big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    shift = small * sin * (mid + small / 4 * (cos * (2 * mid**2 - 1) - small / 6 * mid * (4 * sin**2 - 3) * (4 * mid**2 - 3)))
    return 6378.137 * (1 - f) * big * (sigma - shift)


def loop(vs, us, seconds, radius, remember=False, per_vehicle=False, shared=False):
    """Every vehicle ping looks at every user ping of its window and trip, in order; a memory is a trip's or, if shared, everyone's."""
    out, kept = set(), {}
    slot = lambda t: int((t - START).total_seconds()) // seconds
    for w, trip in sorted({(slot(v[1]), v[2]) for v in vs}):
        matched, full = kept.setdefault(0 if shared else trip, (set(), set())) if remember else (set(), set())
        seated = {}
        users = sorted((u for u in us if slot(u[1]) == w and u[2] == trip), key=lambda u: (u[1], u[3], u[0]))
        for v in sorted((v for v in vs if slot(v[1]) == w and v[2] == trip), key=lambda v: (v[1], v[3], v[0])):
            if v[3] in full:
                continue
            taken = seated.get(v[3], 0) if per_vehicle else 0
            for u in users:
                if u[3] not in matched and taken < v[4] and km(u[4], u[5], v[5], v[6]) <= radius:
                    taken += 1
                    matched.add(u[3])
                    out.add((v[0], u[0], u[3], taken))
                    if taken >= v[4]:
                        full.add(v[3])
            seated[v[3]] = taken
    return out


def result(rides):
    return {(r.v_event, r.u_event, r.cliente_id, r.plazas_ocupadas) for r in rides.collect()}


@pytest.fixture(params=[1, 2, 3])
def pings(request, spark):
    vs, us = data(request.param)
    return vs, us, spark.createDataFrame(vs, V), spark.createDataFrame(us, U)


def test_greedy(pings):
    vs, us, v, u = pings
    assert result(M.greedy_match(v, u, "30 seconds", 2.0)) == loop(vs, us, 30, 2.0)


def test_seats_per_vehicle(pings):
    vs, us, v, u = pings
    assert result(M.greedy_match(v, u, "60 seconds", 2.0, seat_scope="vehicle")) == loop(vs, us, 60, 2.0, per_vehicle=True)


def test_remembering(pings):
    vs, us, v, u = pings
    assert result(M.greedy_match_remembering(v, u, "15 seconds", 3.0)) == loop(vs, us, 15, 3.0, remember=True)


def test_busy_trip_is_sliced_with_the_same_result(spark):
    vs, us = data(9, pings=120, hot=0.6)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    assert result(M.greedy_match_remembering(v, u, "15 seconds", 3.0, max_fold=60)) == loop(vs, us, 15, 3.0, remember=True)


def test_busy_window_is_sliced_with_the_same_result(spark):
    vs, us = data(11, pings=80, hot=0.6, minutes=1)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    assert result(M.greedy_match(v, u, "60 seconds", 3.0, max_fold=500)) == loop(vs, us, 60, 3.0)


@pytest.mark.parametrize("max_fold", [20, 400])
def test_seats_per_vehicle_in_slices(spark, max_fold):
    vs, us = data(13, pings=90, hot=0.5, minutes=2)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    assert result(M.greedy_match(v, u, "60 seconds", 3.0, seat_scope="vehicle", max_fold=max_fold)) == loop(vs, us, 60, 3.0, per_vehicle=True)


def test_one_memory_for_all_trips(spark):
    vs, us = data(14, pings=120, minutes=3)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    expected = loop(vs, us, 15, 3.0, remember=True, shared=True)
    assert result(M.greedy_match_shared_memory(v, u, "15 seconds", 3.0)) == expected != loop(vs, us, 15, 3.0, remember=True)


def test_pairs_of_a_busy_window_are_not_all_made(spark, monkeypatch):
    made, candidates = [], M.candidates

    def counted(*args, **kwargs):
        pairs = candidates(*args, **kwargs)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(M, "candidates", counted)
    rnd = random.Random(4)
    place = lambda: (39.45 + rnd.uniform(0, 0.005), -0.40 + rnd.uniform(0, 0.005))
    vs = [(k, START + dt.timedelta(seconds=rnd.randrange(3000)), 1, k, 60, *place(), *place()) for k in range(300)]
    us = [(k, START + dt.timedelta(seconds=rnd.randrange(3000)), 1, k, *place(), 5.0, "Bizum") for k in range(400)]
    got = result(M.greedy_match(spark.createDataFrame(vs, V), spark.createDataFrame(us, U), "60 minutes", 3.0, max_fold=2000))
    assert got == loop(vs, us, 3600, 3.0) and 400 <= sum(made) < 300 * 400 / 10


def test_one_ping_per_group(spark):
    vs, us = data(4)
    firsts = {}
    for v in sorted(vs, key=lambda v: (v[1], v[3], v[0])):
        firsts.setdefault((int((v[1] - START).total_seconds()) // 30, v[2]), v)
    v, u = spark.createDataFrame(list(firsts.values()), V), spark.createDataFrame(us, U)
    assert result(M.single_ping_match(v, u, "30 seconds", 2.0)) == loop(list(firsts.values()), us, 30, 2.0)


def test_properties(spark):
    vs, us = data(5, pings=150)
    rides = M.greedy_match(spark.createDataFrame(vs, V), spark.createDataFrame(us, U), "30 seconds", 2.0).collect()
    assert rides
    assert len({(r.ventana, r.viaje_id, r.cliente_id) for r in rides}) == len(rides)
    assert all(r.plazas_ocupadas <= r.num_plazas for r in rides)
    assert all(r.timestamp - r.ventana == dt.timedelta(seconds=30) for r in rides)


def test_near_route(spark):
    rnd = random.Random(3)
    points = [(t, p, 39.4 + rnd.uniform(0, 0.1), -0.4 + rnd.uniform(0, 0.1)) for t in (1, 2) for p in range(40)]
    _, us = data(6, pings=100, trips=3, area=0.1)
    found = M.near_route(spark.createDataFrame(us, U), spark.createDataFrame(points, "viaje_id long, punto_ruta long, latitud double, longitud double"), 1.0)
    expected = {u[0] for u in us if any(p[0] == u[2] and km(u[4], u[5], p[2], p[3]) <= 1.0 for p in points)}
    assert {r.event_id for r in found.collect()} == expected and expected
    assert found.columns and found.count() == len(expected)


def test_spread_cells_give_the_same_pairs(spark):
    vs, us = data(8)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    plain, spread = (M.candidates(v, u, "60 seconds", 2.0, spread=n).select("v_event", "u_event", "distancia_km") for n in (1, 5))
    assert plain.count() == spread.count() > 0 and plain.exceptAll(spread).isEmpty()


def test_event_ids_may_repeat(spark):
    """Two sources that number their events alike: a ping is one vehicle at one instant."""
    vs, us = data(12)
    vs = [(v[0] % 4, *v[1:]) for v in vs]
    got = M.greedy_match(spark.createDataFrame(vs, V), spark.createDataFrame(us, U), "30 seconds", 2.0).collect()
    expected = loop(vs, us, 30, 2.0)
    assert {(r.v_event, r.u_event, r.cliente_id, r.plazas_ocupadas) for r in got} == expected and expected
    place = (39.45, -0.4)
    both = [(7, START, 1, 1, 1, *place, *place), (7, START, 1, 2, 1, *place, *place)]
    riders = [(k, START, 1, k, *place, 5.0, "Bizum") for k in (1, 2)]
    rides = M.greedy_match(spark.createDataFrame(both, V), spark.createDataFrame(riders, U), "30 seconds", 2.0)
    assert sorted((r.vehiculo_id, r.cliente_id) for r in rides.collect()) == [(1, 1), (2, 2)]
    seats = M.open_seats(spark.createDataFrame(both, V), rides).select("vehiculo_id", "plazas_ocupadas").collect()
    assert sorted(tuple(r) for r in seats) == [(1, 1), (2, 1)]


def test_incomplete_pings_are_set_aside(spark):
    place = (39.45, -0.4)
    vs = [(1, START, 1, 1, None, *place, *place), (2, START, 1, 2, 1, *place, *place), (3, START, 1, None, 4, *place, *place), (4, None, 1, 4, 4, *place, *place)]
    us = [(k, START, 1, k if k else None, *place, 5.0, None) for k in range(4)] + [(9, START, 1, 9, None, -0.4, 5.0, "Bizum")]
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    assert result(M.greedy_match(v, u, "30 seconds", 2.0)) == {(2, 1, 1, 1)}
    aside = M.set_aside(v, M.VEHICLE_NEEDS)[1].select("event_id", "reason").collect()
    assert {tuple(r) for r in aside} == {(1, "missing num_plazas"), (3, "missing vehiculo_id"), (4, "missing ts")}
    assert {tuple(r) for r in M.set_aside(u, M.USER_NEEDS)[1].select("event_id", "reason").collect()} == {(0, "missing cliente_id"), (9, "missing latitud")}


def test_fares_to_other_continents(spark):
    home = (39.4699, -0.3763)
    goals = [(-33.8688, 151.2093), (-33.4489, -70.6693), (-36.8509, 174.7645), (-39.4699, 179.6237)]
    vs = [(k, START, k, k, 1, *home, *goal) for k, goal in enumerate(goals)]
    us = [(k, START, k, k, *home, 5.0, "Bizum") for k in range(len(goals))]
    fares = {r.viaje_id: r.pago_viaje for r in M.greedy_match(spark.createDataFrame(vs, V), spark.createDataFrame(us, U)).collect()}
    assert all(fares[k] == pytest.approx(km(*home, *goals[k]), abs=1e-3) for k in range(3)) and 19_900 < fares[3] < 20_010
