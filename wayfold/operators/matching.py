"""Matching ride requests to moving vehicles.

Inputs, one row per ping:
  vehicles: ts, event_id, viaje_id, vehiculo_id, num_plazas, latitud, longitud, latitud_final, longitud_final
  users:    ts, event_id, viaje_id, cliente_id, latitud, longitud, rating, metodo_pago

Pings meet when they share trip and tumbling window. Vehicles act in the order (ts, vehiculo_id,
event_id) and look at users in the order (ts, cliente_id, event_id).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.functions import geo
from wayfold.session import durable

VEHICLE_ORDER = ["v_ts", "vehiculo_id", "v_event"]
USER_ORDER = ["u_ts", "cliente_id", "u_event"]

# Above this many vehicle x user pings, the pings of one memory are folded in several tasks.
MAX_FOLD = 20_000_000

# Shares into which the user pings of a cell are split where a memory is that busy.
BUSY_SPREAD = 16


def windowed(pings: DataFrame, window: str) -> DataFrame:
    """Add the start of the epoch-aligned tumbling window as ``ventana``."""
    return pings.withColumn("ventana", F.window("ts", window)["start"])


def _instant(keep_window: bool) -> Column:
    """The ping's time; a stream may carry only one event-time column, which then is the window."""
    return F.timestamp_micros(F.unix_micros("ts")) if keep_window else F.col("ts")


VEHICLE_NEEDS = ["ts", "event_id", "viaje_id", "vehiculo_id", "num_plazas", "latitud", "longitud"]
USER_NEEDS = ["ts", "event_id", "viaje_id", "cliente_id", "latitud", "longitud"]


def set_aside(pings: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pings that can be matched, and the others with a ``reason``: what is missing, first in the order of ``needed``.

    Matching itself only sees the former: a ping without seats, place, time or id can neither take nor be a client.
    """
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in needed])
    return pings.where(missing.isNull()), pings.withColumn("reason", missing).where(F.col("reason").isNotNull())


def _vehicle_side(vehicles: DataFrame, window: str, keep_window: bool = False) -> DataFrame:
    extra = [c for c in ("tramo", "sentados") if c in vehicles.columns]
    return set_aside(vehicles, VEHICLE_NEEDS)[0].select(
        F.window("ts", window).alias("franja"), "viaje_id", _instant(keep_window).alias("v_ts"), "vehiculo_id", F.col("event_id").alias("v_event"),
        "num_plazas", "latitud", "longitud", "latitud_final", "longitud_final", *extra,
    )


def _user_side(users: DataFrame, window: str, keep_window: bool = False) -> DataFrame:
    return set_aside(users, USER_NEEDS)[0].select(
        F.window("ts", window).alias("franja"), "viaje_id", _instant(keep_window).alias("u_ts"), "cliente_id", F.col("event_id").alias("u_event"),
        F.col("latitud").alias("u_latitud"), F.col("longitud").alias("u_longitud"), "rating", "metodo_pago",
    )


def candidates(
    vehicles: DataFrame, users: DataFrame, window: str = "30 seconds", radius_km: float = 2.0,
    keep_window: bool = False, distance: bool = True, spread: int = 1, side_km: float | None = None,
) -> DataFrame:
    """Pairs of a vehicle ping and a user ping of the same trip and window within the radius.

    The grid cell is part of the join key: a vehicle ping is sent to the few cells around it, a user
    ping to its own, so a busy trip spreads over its cells and distances are taken between
    neighbours only. Each pair is found exactly once because a user ping sits in one cell.
    ``keep_window`` leaves the whole window as ``franja``, which a stream needs for its watermark;
    ``distance`` adds the exact distance of every pair, which matching itself does not need.
    ``spread`` splits the user pings of every cell into that many shares and sends the vehicle pings
    to each, for cells that hold too many pings for one task. ``side_km`` makes cells wider than the
    radius, so that a vehicle ping is sent to fewer of them.
    """
    v = _vehicle_side(vehicles, window, keep_window).withColumn(
        "celda", F.explode(geo.cells_around("latitud", "longitud", radius_km, side_km))
    )
    u = _user_side(users, window, keep_window).withColumn("celda", geo.cell("u_latitud", "u_longitud", side_km or radius_km))
    keys = ["franja", "viaje_id", "celda"]
    if spread > 1:
        v = v.withColumn("parte", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
        u = u.withColumn("parte", F.pmod(F.xxhash64("u_event", "cliente_id"), F.lit(spread)))
        keys.append("parte")
    pairs = v.join(u, keys).drop("celda", "parte")
    if not keep_window:
        pairs = pairs.select(F.col("franja.start").alias("ventana"), *[c for c in pairs.columns if c != "franja"])
    here = ("latitud", "longitud", "u_latitud", "u_longitud")
    near = pairs.where(geo.is_within_km(*here, radius_km))
    return geo.with_geodesic_km(near, *here, "distancia_km") if distance else near


def near_route(users: DataFrame, points: DataFrame, radius_km: float = 2.0) -> DataFrame:
    """User pings for which any point of their trip's route lies within the radius.

    A semi join on trip and grid cell: a ping sits in one cell and is settled by its first near
    point, and the key spreads a long route over its cells. The distinct route points, the small
    side, are sent to the cells around them.
    """
    here = users.withColumn("celda", geo.cell("latitud", "longitud", radius_km))
    route = points.select("viaje_id", "latitud", "longitud").distinct().select(
        F.col("viaje_id").alias("_viaje"), F.explode(geo.cells_around("latitud", "longitud", radius_km)).alias("_celda"),
        F.col("latitud").alias("_lat"), F.col("longitud").alias("_lon"),
    )
    near = (F.col("viaje_id") == F.col("_viaje")) & (F.col("celda") == F.col("_celda")) & geo.is_within_km("latitud", "longitud", "_lat", "_lon", radius_km)
    return here.join(route, near, "left_semi").select(*users.columns)


def cogroup(vehicles: DataFrame, users: DataFrame, window: str = "30 seconds") -> DataFrame:
    """Full outer grouping of both streams by (window, trip): how many pings, vehicles and clients
    each side brings, keeping groups that only one side has.

    Groups are summarised, not collected; the rows themselves stay reachable by the same key.
    """
    v = windowed(vehicles, window).select("ventana", "viaje_id", "vehiculo_id", F.lit(None).cast("long").alias("cliente_id"))
    u = windowed(users, window).select("ventana", "viaje_id", F.lit(None).cast("long").alias("vehiculo_id"), "cliente_id")
    return v.unionByName(u).groupBy("ventana", "viaje_id").agg(
        F.count("vehiculo_id").alias("pings_vehiculo"),
        F.count("cliente_id").alias("pings_cliente"),
    )


COGROUP_ROW = ["ventana", "viaje_id", "lado", "ts", "id", "event_id", "latitud", "longitud"]


def cogroup_rows(vehicles: DataFrame, users: DataFrame, window: str = "30 seconds") -> DataFrame:
    """The rows behind ``cogroup``: all pings of a (window, trip), vehicles (``lado`` 0) before clients (1), each side in matching order.

    Rows are dealt by group and sorted, never gathered, so a group may be larger than a task's memory.
    """
    sides = [
        windowed(pings, window).select("ventana", "viaje_id", F.lit(side).alias("lado"), "ts", F.col(one).alias("id"), "event_id", "latitud", "longitud")
        for side, (pings, one) in enumerate(((vehicles, "vehiculo_id"), (users, "cliente_id")))
    ]
    return sides[0].unionByName(sides[1]).repartition("ventana", "viaje_id").sortWithinPartitions(*COGROUP_ROW[:6])


def fold_groups(rows: DataFrame, keys: list[str], fold, schema: T.StructType | str) -> DataFrame:
    """Hand the rows of each group, as they stand, to ``fold(key, rows)``, which yields rows of ``schema``.

    ``rows`` must be dealt and sorted by ``keys``, as ``cogroup_rows`` are. The fold sees an iterator of named tuples, so it
    holds what it keeps itself.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = (row for pdf in batches for row in pdf.itertuples(index=False))
        out = []
        for key, own in itertools.groupby(each, lambda row: tuple(getattr(row, k) for k in keys)):
            for made in fold(key, own):
                out.append(made)
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kind.names
    return rows.mapInPandas(run, kind)


def seat_fold(unit: list[str], seat_scope: str):
    """First-come seat assignment over candidate pairs that arrive in matching order.

    Holds only the client and vehicle ids used so far in the current unit; pairs stream through. A column ``sentados``
    says how many clients earlier slices have seated in the vehicle.
    An inner function travels to the executors by value, so they need not have this package.
    """
    per_vehicle = seat_scope == "vehicle"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = at = None
        matched, full, seated, occupied, closed = set(), set(), {}, 0, False
        for pdf in batches:
            taken = np.zeros(len(pdf), dtype="int64")
            units = zip(*[pdf[c].tolist() for c in unit])
            instants = pdf["v_ts"].astype("int64").tolist()
            before = pdf["sentados"].tolist() if "sentados" in pdf else [0] * len(pdf)
            ids = zip(instants, *[pdf[c].tolist() for c in ("vehiculo_id", "v_event", "num_plazas", "cliente_id")], before)
            for i, (here, (instant, vehicle, event, seats, client, start)) in enumerate(zip(units, ids)):
                if here != current:
                    current, at, matched, full, seated = here, None, set(), set(), {}
                # Event ids may repeat between sources; a ping is one vehicle at one instant.
                if (instant, vehicle, event) != at:
                    at, closed = (instant, vehicle, event), vehicle in full
                    occupied = seated.get(vehicle, start) if per_vehicle else 0
                if closed or occupied >= seats or client in matched:
                    continue
                matched.add(client)
                occupied += 1
                taken[i] = occupied
                seated[vehicle] = occupied
                if occupied >= seats:
                    full.add(vehicle)
            pdf["plazas_ocupadas"] = taken
            yield pdf[taken > 0]

    return fold


def _fold(pairs: DataFrame, unit: list[str], seat_scope: str) -> DataFrame:
    """Send each unit to one task, in matching order, and stream it through the seat fold."""
    order = [*unit, *(c for c in ["ventana"] if c not in unit), *VEHICLE_ORDER, *USER_ORDER]
    schema = T.StructType(pairs.schema.fields + [T.StructField("plazas_ocupadas", T.LongType())])
    return pairs.repartition(*unit).sortWithinPartitions(*order).mapInPandas(seat_fold(unit, seat_scope), schema)


def _busy(vehicles: DataFrame, users: DataFrame, window: str, scope: list[str], max_fold: int) -> DataFrame:
    """Memories (groups that share matched clients) with more ping pairs than one task should fold."""
    sides = [windowed(p, window).select("ventana", "viaje_id", F.lit(v).alias("v"), F.lit(1 - v).alias("u")) for p, v in ((vehicles, 1), (users, 0))]
    pairs = sides[0].unionByName(sides[1]).groupBy("ventana", "viaje_id").agg((F.sum("v").cast("double") * F.sum("u")).alias("pares"))
    return (pairs if scope == ["ventana", "viaje_id"] else pairs.groupBy(*scope).agg(F.sum("pares").alias("pares"))).where(F.col("pares") > max_fold)


def _slice_bounds(vehicles: DataFrame, busy: DataFrame, window: str, scope: list[str], slices: int) -> DataFrame:
    """Times that cut the vehicle pings of each busy memory into slices, each about as long as all before it."""
    shares = [0.5**k for k in range(slices - 1, 0, -1)]
    when = F.unix_micros(F.col("ts").cast("timestamp"))
    return (
        windowed(vehicles, window).join(busy.select(*scope), scope)
        .groupBy(*scope)
        .agg(F.array_distinct(F.percentile_approx(when, shares, 10000)).alias("cortes"))
    )


def _progressive(cut: DataFrame, users: DataFrame, window: str, radius_km: float, scope: list[str], seat_scope: str, slices: int) -> DataFrame:
    """Exact assignment for busy memories, one growing time slice after the other.

    Candidates of a slice are made only when all earlier slices are settled, from clients not yet matched and vehicles not
    yet filled. Of a pair within the radius, the client is matched or the vehicle out of seats once its slice is over. Where
    clients are fewer than seats, few are left after the first slices and the pairs that are ever made grow about with the
    pings; where seats are fewer, every slice still meets all clients near it that are left.
    """
    cut, users, done = durable(cut, "cut"), durable(users, "open_users"), []
    for k in range(slices):
        v, u = cut.where(F.col("tramo") == k), users
        if done:
            before = functools.reduce(DataFrame.unionByName, done)
            filled = before.where("plazas_ocupadas >= num_plazas").select(*scope, "vehiculo_id").distinct()
            v = windowed(v, window).join(filled, [*scope, "vehiculo_id"], "left_anti")
            u = windowed(u, window).join(before.select(*scope, "cliente_id").distinct(), [*scope, "cliente_id"], "left_anti")
            if seat_scope == "vehicle":
                seated = before.groupBy(*scope, "vehiculo_id").agg(F.max("plazas_ocupadas").alias("sentados"))
                v = v.join(seated, [*scope, "vehiculo_id"], "left").withColumn("sentados", F.coalesce("sentados", F.lit(0).cast("long")))
        pairs = candidates(v, u, window, radius_km, distance=False, spread=BUSY_SPREAD)
        done.append(durable(_fold(pairs, scope, seat_scope).drop("sentados"), "slice"))
    return functools.reduce(DataFrame.unionByName, done)


def _first_use(matches: DataFrame, scope: list[str]) -> DataFrame:
    """Slice in which each client was first matched and each vehicle first filled."""
    clients = matches.select(*scope, "tramo", F.lit("c").alias("kind"), F.col("cliente_id").alias("id"))
    vehicles = matches.where("plazas_ocupadas >= num_plazas").select(*scope, "tramo", F.lit("v").alias("kind"), F.col("vehiculo_id").alias("id"))
    return clients.unionByName(vehicles).groupBy(*scope, "kind", "id").agg(F.min("tramo").alias("uso"))


def _of_kind(used: DataFrame, kind: str, key: str) -> DataFrame:
    return used.where(F.col("kind") == kind).drop("kind").withColumnRenamed("id", key)


KINDS = (("c", "cliente_id"), ("v", "vehiculo_id"))


def _replay_slices(pairs: DataFrame, scope: list[str], seat_scope: str) -> DataFrame:
    """Exact assignment for memories that are cut into parts, ordered by ``tramo``, parts in parallel.

    A slice needs to know which clients were matched and which vehicles were filled in earlier
    slices. First every slice is folded as if nothing had been used. Each round then looks up who was
    used where, and folds again only the slices for which that changes who is still free. Slice k is
    right from round k on, because by then all before it are, so the rounds end; and when no slice
    is affected any more, every slice has been folded under true premises. Usually a few rounds do,
    since most clients are first matched in the slice where they appear.
    """
    unit = [*scope, "tramo"]
    pairs = durable(pairs, "pairs")
    matches = durable(_fold(pairs, unit, seat_scope), "matches")
    used = durable(_first_use(matches, scope), "used")
    changed = used.select(*scope, "kind", "id", F.col("uso").alias("desde"), F.lit(None).cast(used.schema["uso"].dataType).alias("hasta"))
    while True:
        touched = [
            pairs.select(*unit, key).join(_of_kind(changed, kind, key), [*scope, key])
            .where((F.col("tramo") > F.col("desde")) & (F.col("hasta").isNull() | (F.col("tramo") <= F.col("hasta")))).select(*unit)
            for kind, key in KINDS
        ]
        affected = durable(touched[0].unionByName(touched[1]).distinct(), "affected")
        if affected.isEmpty():
            return matches
        free = pairs.join(affected, unit, "left_semi")
        for kind, key in KINDS:
            free = free.join(_of_kind(used, kind, key), [*scope, key], "left").where(
                F.col("uso").isNull() | (F.col("uso") >= F.col("tramo"))
            ).drop("uso")
        again = _fold(free.select(*pairs.columns), unit, seat_scope)
        matches = durable(matches.join(affected, unit, "left_anti").select(*again.columns).unionByName(again), "matches")
        fresh = durable(_first_use(matches, scope), "used")
        both = fresh.join(used.withColumnRenamed("uso", "antes"), [*scope, "kind", "id"], "full")
        changed = both.where(~F.col("uso").eqNullSafe(F.col("antes"))).select(
            *scope, "kind", "id", F.least("uso", "antes").alias("desde"),
            F.when(F.col("uso").isNotNull() & F.col("antes").isNotNull(), F.greatest("uso", "antes")).alias("hasta"),
        )
        used = fresh


def _assign(vehicles: DataFrame, users: DataFrame, window: str, radius_km: float, scope: list[str], seat_scope: str, max_fold: int | None) -> DataFrame:
    if seat_scope not in ("ping", "vehicle"):
        raise ValueError(f"unknown seat_scope {seat_scope!r}")
    if max_fold is None:
        return _fold(candidates(vehicles, users, window, radius_km, distance=False), scope, seat_scope)
    busy = _busy(vehicles, users, window, scope, max_fold)
    largest = busy.agg(F.max("pares")).first()[0]
    if largest is None:
        return _fold(candidates(vehicles, users, window, radius_km, distance=False), scope, seat_scope)
    busy = durable(busy, "busy")
    slices = math.ceil(math.log2(largest / max_fold)) + 1
    bounds = durable(_slice_bounds(vehicles, busy, window, scope, slices), "bounds")
    v, u = windowed(vehicles, window), windowed(users, window)
    when = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = v.join(bounds, scope).withColumn("tramo", F.size(F.filter("cortes", lambda b: b < when))).drop("cortes", "ventana")
    calm = _fold(
        candidates(v.join(busy, scope, "left_anti").drop("ventana"), u.join(busy, scope, "left_anti").drop("ventana"), window, radius_km, distance=False),
        scope, seat_scope,
    )
    sliced = _progressive(cut, u.join(busy, scope, "left_semi").drop("ventana"), window, radius_km, scope, seat_scope, slices)
    return calm.unionByName(sliced.drop("tramo"))


HERE_TO_GOAL = ("latitud", "longitud", "latitud_final", "longitud_final")


def priced(matches: DataFrame, rate: float, stamp: Column, far: bool = True) -> DataFrame:
    """Ride rows of matched pairs. The fare is worked out here, for matches only; without ``far`` it is NULL where the series needs more steps."""
    return _as_rides(geo.with_geodesic_km(matches, *HERE_TO_GOAL, "_km", far=far), rate, stamp)


def _as_rides(measured: DataFrame, rate: float, stamp: Column) -> DataFrame:
    return measured.select(
        "ventana", "viaje_id", "vehiculo_id", "v_event", "v_ts", "num_plazas", "plazas_ocupadas", "cliente_id", "u_event",
        F.col("rating").cast("double").alias("rating"), "metodo_pago", geo.fare("_km", rate).alias("pago_viaje"),
        "latitud", "longitud", "latitud_final", "longitud_final", stamp.alias("timestamp"),
    )


def _rides(matches: DataFrame, window: str, rate: float, stamp: Column | None) -> DataFrame:
    """Rides of a batch: the matches are written, and only those too far for the series go the long way, if there are any."""
    stamp = F.col("ventana") + F.expr(f"INTERVAL {window}") if stamp is None else stamp
    matches = durable(matches, "matches")
    measured = geo.with_geodesic_km(matches, *HERE_TO_GOAL, "_km")
    given = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in HERE_TO_GOAL])
    far = measured.where(F.col("_km").isNull() & given)
    if far.isEmpty():
        return _as_rides(measured, rate, stamp)
    near = measured.where(F.col("_km").isNotNull() | ~given)
    return _as_rides(near.unionByName(far.withColumn("_km", geo.settled_km(*HERE_TO_GOAL))), rate, stamp)


def greedy_match(
    vehicles: DataFrame, users: DataFrame, window: str = "30 seconds", radius_km: float = 2.0, rate: float = 1.0,
    seat_scope: str = "ping", stamp: Column | None = None, max_fold: int | None = MAX_FOLD,
) -> DataFrame:
    """First-come assignment of clients to seats, separately per (window, trip).

    Seats are counted per ping (``seat_scope='ping'``), so a vehicle whose pings stay below capacity
    may carry more clients in a window than it has seats; ``'vehicle'`` counts them per vehicle.
    ``stamp`` fills ``timestamp``; by default it is the window's end. Groups with more than
    ``max_fold`` ping pairs are settled in growing time slices (same result).
    """
    matches = _assign(vehicles, users, window, radius_km, ["ventana", "viaje_id"], seat_scope, max_fold)
    return _rides(matches, window, rate, stamp)


def greedy_match_remembering(
    vehicles: DataFrame, users: DataFrame, window: str = "15 seconds", radius_km: float = 5.0, rate: float = 1.0,
    stamp: Column | None = None, max_fold: int | None = MAX_FOLD,
) -> DataFrame:
    """As ``greedy_match``, but matched clients and filled vehicles stay out in all later windows of
    their trip. Busy trips are settled in growing time slices (same result)."""
    matches = _assign(vehicles, users, window, radius_km, ["viaje_id"], "ping", max_fold)
    return _rides(matches, window, rate, stamp)


def greedy_match_shared_memory(
    vehicles: DataFrame, users: DataFrame, window: str = "15 seconds", radius_km: float = 5.0, rate: float = 1.0, stamp: Column | None = None,
) -> DataFrame:
    """As ``greedy_match_remembering``, but one memory spans all trips: a client matched or a vehicle filled on any trip is
    out of all later windows, and within a window of trips with a higher number.

    Every (window, trip) is folded by itself; then only those are folded again that use an id which an earlier one has
    taken, until none does.
    """
    pairs = candidates(vehicles, users, window, radius_km, distance=False).withColumn("tramo", F.struct("ventana", "viaje_id"))
    return _rides(_replay_slices(pairs, [], "ping").drop("tramo"), window, rate, stamp)


def single_ping_match(vehicles: DataFrame, users: DataFrame, window: str = "30 seconds", radius_km: float = 2.0, rate: float = 1.0) -> DataFrame:
    """``greedy_match`` where each (window, trip) has one vehicle ping: its first ``num_plazas``
    distinct clients by first candidate ping. No Python is involved."""
    pairs = candidates(vehicles, users, window, radius_km, distance=False)
    ping = ["ventana", "viaje_id", "v_ts", "vehiculo_id", "v_event"]
    keys = [*ping, "cliente_id"]
    others = [c for c in pairs.columns if c not in keys]
    # A client's first candidate ping, combined before the shuffle; then the first seats inside
    # shares of the clients, so that a ping which very many can reach is not ranked by one task.
    first = pairs.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct("u_ts", "u_event")).alias("_p")).select(*keys, "_p.*")
    parts = Window.partitionBy(*ping, "_part").orderBy(*USER_ORDER)
    best = (
        first.withColumn("_part", F.pmod(F.xxhash64("cliente_id"), F.lit(64)))
        .withColumn("_n", F.row_number().over(parts)).where("_n <= num_plazas").drop("_n", "_part")
    )
    seats = Window.partitionBy(*ping).orderBy(*USER_ORDER)
    matches = best.withColumn("plazas_ocupadas", F.row_number().over(seats).cast("long")).where("plazas_ocupadas <= num_plazas")
    return _rides(matches, window, rate, None)


def occupancy_log(rides: DataFrame) -> DataFrame:
    """Per match: seats taken after it, seats left, and where the vehicle was."""
    return rides.select(
        "ventana", "viaje_id", "vehiculo_id", "v_event", "cliente_id", "plazas_ocupadas",
        (F.col("num_plazas") - F.col("plazas_ocupadas")).alias("plazas_libres"), "latitud", "longitud",
    )


def full_vehicles(rides: DataFrame) -> DataFrame:
    """Vehicle pings that ended full. Only the match that took the last seat is kept: no grouping needed."""
    return rides.where("plazas_ocupadas >= num_plazas").select("ventana", "viaje_id", "vehiculo_id", "v_event", "num_plazas")


def unmatched(users: DataFrame, rides: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Pings of clients that no ride of their trip has taken; ``within`` names further columns that must agree, as the window."""
    keys = ["cliente_id", "viaje_id", *(within or [])]
    return users.join(rides.select(*keys).distinct(), keys, "left_anti")


def finished(pings: DataFrame) -> DataFrame:
    return pings.withColumn("viaje_finalizado", geo.finished())


def latest_position(pings: DataFrame) -> DataFrame:
    """Where each vehicle was last seen, and whether that is its destination."""
    last = F.max_by(F.struct("latitud", "longitud", "latitud_final", "longitud_final"), F.struct("ts", "event_id"))
    return finished(pings.groupBy("vehiculo_id").agg(last.alias("_p")).select("vehiculo_id", "_p.*"))


def open_seats(pings: DataFrame, rides: DataFrame) -> DataFrame:
    """Seat predicates per vehicle ping: taken seats, full, available."""
    taken = rides.groupBy(F.col("v_event").alias("event_id"), "vehiculo_id", F.col("v_ts").alias("ts")).agg(F.max("plazas_ocupadas").alias("plazas_ocupadas"))
    state = finished(pings.join(taken, ["event_id", "vehiculo_id", "ts"], "left")).withColumn(
        "plazas_ocupadas", F.coalesce("plazas_ocupadas", F.lit(0))
    )
    return state.withColumn("lleno", geo.is_full("plazas_ocupadas", "num_plazas")).withColumn(
        "disponible", geo.is_available("plazas_ocupadas", "num_plazas", "viaje_finalizado")
    )
