"""Small event sets for tests, and plain-Python forms of what the plans compute."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from gatewatch import schemas

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def event(seconds: float, user: str = "U1", host: str = "C1", event_id: str | None = None, success=True):
    name = event_id or f"{seconds}-{user}-{host}"
    return (START + timedelta(seconds=seconds), user, None, host, success, name)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS)


def skewed_events(count: int = 600, seed: int = 7):
    """Random events of four days; user U0 and host C0 hold a good third of all, with ties."""
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        user = "U0" if rng.random() < 0.4 else f"U{rng.randrange(1, 6)}"
        host = "C0" if rng.random() < 0.4 else f"C{rng.randrange(1, 9)}"
        second = rng.randrange(0, 4 * 86400, 60) if rng.random() < 0.5 else rng.random() * 4 * 86400
        rows.append(event(second, user, host, f"e{n:04d}"))
    return rows


def first_seen(rows):
    """Ids of the first event of every (user, host)."""
    seen, found = set(), set()
    for row in sorted(rows, key=lambda r: (r[0], r[5])):
        if (row[1], row[3]) not in seen:
            seen.add((row[1], row[3]))
            found.add(row[5])
    return found


def windows(rows, duration: int, slide: int):
    """(start, user) -> (hosts, events, any first-seen) by copying events into windows."""
    new, found = first_seen(rows), {}
    for time, user, _, host, _, name in rows:
        second = time.timestamp()
        start = int(second // slide) * slide
        while start > second - duration:
            hosts, events, flag = found.get((start, user), (frozenset(), 0, False))
            found[(start, user)] = (hosts | {host}, events + 1, flag or name in new)
            start -= slide
    return {key: (len(hosts), events, flag) for key, (hosts, events, flag) in found.items()}


def as_windows(df):
    return {
        (int(r.window_start.replace(tzinfo=timezone.utc).timestamp()), r.user_id): (
            r.unique_hosts,
            r.event_count,
            r.has_new_device,
        )
        for r in df.collect()
    }
