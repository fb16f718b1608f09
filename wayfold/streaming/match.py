"""The matcher on unbounded input.

Trips share buckets, so that small trips and windows cost no call of their own. Candidate pairs reach the state of their
bucket as rows; beyond a bounded number they are filed by time slice of the vehicle ping. When the watermark has passed
a window, a timer walks through its slices in order and folds them one by one, so a task holds the bounded rows, the
pairs of one slice and the ids used so far, never those of a whole window.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wayfold.operators.matching import candidates, priced

#: What a candidate pair carries into the fold, matching order first; instants are microseconds.
ORDER = ["v_us", "vehiculo_id", "v_event", "u_us", "cliente_id", "u_event"]
PAIR = [*ORDER, "num_plazas", "latitud", "longitud", "latitud_final", "longitud_final", "rating", "metodo_pago"]
#: Slices of a window, where no span is given.
SLICES = 16
#: Buckets of the units (trips, or a window's trips) that are folded by themselves. Part of the state: a checkpoint keeps its number.
BUCKETS = 1024
#: Rows that a bucket files without looking at window and slice.
LOOSE = 50_000
#: Width of the join's grid cells in radii. Wider cells hold more partners to test, and a vehicle ping is kept in fewer of them.
SIDE = 4


def near_pairs(vehicles: DataFrame, users: DataFrame, window: str, radius_km: float, watermark: str) -> DataFrame:
    """Candidate pairs as the streams bring them, each with its window's bounds in microseconds.

    The streams are joined on window, trip and grid cell, so join state and distance work spread over cells, and only
    pairs within the radius go on. ``momento`` carries the watermark (that of the slower stream); later records are dropped.
    """
    pairs = candidates(vehicles.withWatermark("ts", watermark), users.withWatermark("ts", watermark), window, radius_km, keep_window=True, distance=False, side_km=SIDE * radius_km)
    return pairs.select(
        F.window_time("franja").alias("momento"), F.unix_micros("franja.start").alias("inicio"), F.unix_micros("franja.end").alias("cierre"), "viaje_id",
        F.unix_micros("v_ts").alias("v_us"), F.unix_micros("u_ts").alias("u_us"), *[c for c in PAIR if c not in ("v_us", "u_us")],
    )


def match_stream(
    vehicles: DataFrame, users: DataFrame, window: str = "30 seconds", radius_km: float = 2.0, watermark: str = "0 seconds",
    remember: bool = False, rate: float = 1.0, ttl_ms: int | None = None, stamp: Column | None = None, time_slice: str | None = None,
) -> DataFrame:
    """Rides as a stream, in append mode.

    ``remember=False`` matches every window on its own. ``remember=True`` keeps matched clients and
    filled vehicles of each trip in the state store and leaves them out of later windows; ``ttl_ms``
    forgets them once a window ends that long after the one that took them (never, if left out). ``stamp`` fills
    ``timestamp``, for instance with the current time; by default it is the window's end. ``time_slice`` bounds what is folded at once:
    the pairs of a bucket of trips whose vehicle pings fall into that span, by default a sixteenth of the window.
    """
    pairs = near_pairs(vehicles, users, window, radius_km, watermark)
    kept = [f for f in pairs.schema.fields if f.name in ("inicio", "cierre", "viaje_id", *PAIR)]
    schema = T.StructType([*kept, T.StructField("plazas_ocupadas", T.LongType())])
    unit = ["viaje_id"] if remember else ["viaje_id", "inicio"]
    span = max(int(pd.Timedelta(time_slice or window) / pd.Timedelta(microseconds=1)) // (1 if time_slice else SLICES), 1)
    folded = pairs.withColumn("cubo", F.pmod(F.xxhash64(*unit), F.lit(BUCKETS))).groupBy("cubo").transformWithStateInPandas(
        statefulProcessor=slice_fold(schema, span, remember, None if ttl_ms is None else ttl_ms * 1000), outputStructType=schema,
        outputMode="Append", timeMode="EventTime",
    )
    matches = folded.select(
        F.timestamp_micros("inicio").alias("ventana"), F.timestamp_micros("cierre").alias("cierre"), F.timestamp_micros("v_us").alias("v_ts"),
        *[c for c in schema.names if c not in ("inicio", "cierre", "v_us", "u_us")],
    )
    return priced(matches, rate, F.col("cierre") if stamp is None else stamp)


def slice_fold(schema: T.StructType, span: int, remember: bool, ttl: int | None) -> StatefulProcessor:
    """Processor that files the pairs of a bucket of trips and folds a window once it is closed.

    The first ``LOOSE`` rows of a bucket are filed as they come, further ones by (window, slice of ``span`` microseconds);
    rows of one slice that come in one batch are one entry, and a slice knows how many entries it has. One timer a bucket
    waits for the first window that closes. With ``remember``, ids of matched clients and filled vehicles of each trip stay
    in state with the window that took them, and with ``ttl`` the timer removes them. The class is local so that it travels
    to the executors by value.
    """
    names, order, most = schema.names, ORDER, LOOSE

    def longs(*fields: str) -> T.StructType:
        return T.StructType([T.StructField(f, T.LongType()) for f in fields])

    binary = T.StructType([T.StructField("filas", T.BinaryType())])

    def packed(rows: pd.DataFrame) -> bytes:
        table, sink = pa.Table.from_pandas(rows, preserve_index=False), io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue()

    def unpacked(data: bytes) -> pd.DataFrame:
        with pa.ipc.open_stream(data) as reader:
            return reader.read_pandas()

    def millis(instant: int) -> int:
        return -(-instant // 1000)

    class Memory:
        """Ids of one kind that may not be used again: those of this window, and with a store those of earlier ones."""

        def __init__(self, store):
            self.store, self.known, self.fresh = store, {}, {}

        def has(self, one: tuple[int, int], close: int) -> bool:
            if one not in self.known:
                seen = self.store.getValue(one) if self.store is not None else None
                self.known[one] = None if seen is None else seen[0]
            taken = self.known[one]
            return taken is not None and (ttl is None or taken == close or taken + ttl > close)

        def add(self, one: tuple[int, int], close: int) -> None:
            self.known[one] = close
            if self.store is not None:
                self.store.updateValue(one, (close,))
                if ttl is not None:
                    self.fresh.setdefault(close, []).append(one)

    class Folding(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.loose = handle.getListState("sueltos", binary)
            # Rows among the loose ones, and the instant of the timer that is set.
            self.noted = handle.getValueState("notas", longs("sueltos", "aviso"))
            self.sizes = handle.getMapState("tramos", longs("cierre", "tramo"), longs("partes"))
            self.parts = handle.getMapState("partes", longs("cierre", "tramo", "parte"), binary)
            self.matched = handle.getMapState("clientes", longs("viaje", "id"), longs("cierre")) if remember else None
            self.full = handle.getMapState("vehiculos", longs("viaje", "id"), longs("cierre")) if remember else None
            self.taken = handle.getMapState("usados", longs("cierre", "clase"), binary) if ttl is not None else None

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            count, due = self.noted.get() or (0, None)
            closes, fresh = set(), []
            for pdf in rows:
                own = pdf[names[:-1]]
                closes.add(int(own["cierre"].min()))
                if count + len(own) <= most:
                    count += len(own)
                    fresh.append((packed(own),))
                else:
                    self.file(own)
            if fresh:
                self.loose.appendList(fresh)
            self.wait(count, due, closes)
            return iter([])

        def file(self, rows: pd.DataFrame) -> None:
            """Add rows to their (window, slice)."""
            for (close, part), own in rows.groupby([rows["cierre"], rows["v_us"] // span]):
                at = (int(close), int(part))
                size = self.sizes.getValue(at)
                count = 0 if size is None else size[0]
                self.parts.updateValue((*at, count), (packed(own),))
                self.sizes.updateValue(at, (count + 1,))

        def wait(self, count: int, due: int | None, instants: set[int]) -> None:
            """Set a timer for the first of ``instants``, unless an earlier one is set."""
            first = min(instants, default=None)
            if first is not None and (due is None or first < due):
                self.handle.registerTimer(millis(first))
                due = first
            self.noted.update((count, due))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # All windows behind the watermark act now, in time order; later timers find nothing left of them.
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
            count, due = self.noted.get() or (0, None)
            filed, later = [], set()
            for (close, part), size in self.sizes.iterator():
                if close <= now:
                    filed.append((int(close), int(part), int(size[0])))
                else:
                    later.add(int(close))
            loose = None
            if count:
                loose = pd.concat([unpacked(data) for (data,) in self.loose.get()], ignore_index=True)
                kept = loose[loose["cierre"] > now]
                if len(kept) < count:
                    self.loose.put([(packed(kept),)]) if len(kept) else self.loose.clear()
                    count, loose = len(kept), loose[loose["cierre"] <= now]
                else:
                    loose = None
                later.update([int(kept["cierre"].min())] if len(kept) else [])
            memories = (Memory(self.matched), Memory(self.full))
            at = None
            for rows in self.closed(loose, sorted(filed)):
                at, out = self.fold(rows, at, *memories)
                if len(out):
                    yield out
            if ttl is not None:
                self.keep(memories)
                later.update(self.forget(now - ttl))
            self.wait(count, None if due is None or due <= now else due, later)

        def closed(self, loose: pd.DataFrame | None, filed: list[tuple[int, int, int]]) -> Iterator[pd.DataFrame]:
            """The rows of closed windows in the order they act: loose ones up to a filed slice, then that slice, which is read only now."""
            first = ["cierre", "tramo", "viaje_id", *order]
            if loose is not None:
                loose = loose.assign(tramo=loose["v_us"] // span).sort_values(first, kind="stable")
            for here, part, count in filed:
                own = []
                if loose is not None:
                    before = (loose["cierre"] < here) | ((loose["cierre"] == here) & (loose["tramo"] < part))
                    same = (loose["cierre"] == here) & (loose["tramo"] == part)
                    if before.any():
                        yield loose[before]
                    own, loose = [loose[same]] * bool(same.any()), loose[~before & ~same]
                places = [(here, part, k) for k in range(count)]
                rows = pd.concat([*own, *[unpacked(self.parts.getValue(p)[0]) for p in places]], ignore_index=True).assign(tramo=part)
                for place in places:
                    self.parts.removeKey(place)
                self.sizes.removeKey((here, part))
                yield rows.sort_values(first, kind="stable")
            if loose is not None and len(loose):
                yield loose

        def fold(self, rows: pd.DataFrame, current: int | None, matched: Memory, full: Memory) -> tuple[int | None, pd.DataFrame]:
            """The window that acted last, ``current`` if none has, and the rides; all pairs of a vehicle ping are in one call."""
            at, occupied, closed, seats_after = None, 0, False, []
            for close, trip, instant, vehicle, event, client, seats in zip(*[rows[c].tolist() for c in ("cierre", "viaje_id", "v_us", "vehiculo_id", "v_event", "cliente_id", "num_plazas")]):
                if close != current:
                    current = close
                    if not remember:
                        matched.known, full.known = {}, {}
                if (close, trip, instant, vehicle, event) != at:
                    at, occupied, closed = (close, trip, instant, vehicle, event), 0, full.has((trip, vehicle), close)
                if closed or occupied >= seats or matched.has((trip, client), close):
                    seats_after.append(0)
                    continue
                occupied += 1
                matched.add((trip, client), close)
                if occupied >= seats:
                    full.add((trip, vehicle), close)
                seats_after.append(occupied)
            rows = rows.assign(plazas_ocupadas=seats_after)
            return current, rows[rows["plazas_ocupadas"] > 0][names]

        def keep(self, memories: tuple[Memory, Memory]) -> None:
            """Note what each window took, so that it can be forgotten."""
            for kind, memory in enumerate(memories):
                for close, ids in memory.fresh.items():
                    before = self.taken.getValue((close, kind))
                    self.taken.updateValue((close, kind), ((b"" if before is None else bytes(before[0])) + np.array(ids, np.int64).tobytes(),))

        def forget(self, until: int) -> set[int]:
            """Drop what windows up to ``until`` took; the instants at which others are due."""
            noted = [(int(c), int(k)) for c, k in self.taken.keys()]
            for close, kind in (one for one in noted if one[0] <= until):
                store = (self.matched, self.full)[kind]
                for trip, one in np.frombuffer(self.taken.getValue((close, kind))[0], np.int64).reshape(-1, 2).tolist():
                    seen = store.getValue((trip, one))
                    if seen is not None and seen[0] == close:
                        store.removeKey((trip, one))
                self.taken.removeKey((close, kind))
            return {close + ttl for close, _ in noted if close > until}

        def close(self) -> None:
            pass

    return Folding()
