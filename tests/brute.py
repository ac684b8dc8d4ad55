"""The operators' definitions once more, row by row over small lists."""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import groupby

GAP = 1_800_000


def sessions(clicks, key=lambda c: c["trackingId"], gap=GAP):
    """(trackingId, timestamp, start, end, pages) of every click."""
    by_key = defaultdict(list)
    for click in clicks:
        by_key[key(click)].append(click)
    out = []
    for group in by_key.values():
        group = sorted(group, key=lambda c: c["timestamp"])
        current = []
        for click in group:
            if current and click["timestamp"] - current[-1]["timestamp"] > gap:
                out += _closed(current)
                current = []
            current.append(click)
        out += _closed(current)
    return sorted(out)


def _closed(current):
    start, end = current[0]["timestamp"], current[-1]["timestamp"]
    return [
        (click["trackingId"], click["timestamp"], start, end, len(current)) for click in current
    ]


def next_timestamps(rows, ties):
    """(key, timestamp, *ties, next timestamp) of distinct (key, timestamp, *ties) rows."""
    out = []
    for key, group in groupby(sorted(set(rows)), key=lambda row: row[0]):
        group = list(group)
        for row, following in zip(group, [*group[1:], None]):
            out.append((*row, following[1] if following else None))
    return sorted(out, key=repr)


def dwell_totals(clicks):
    """(day, item) -> ms; clicks are (day, session, timestamp, item)."""
    totals = defaultdict(int)
    ordered = sorted(clicks)
    for _, group in groupby(ordered, key=lambda c: (c[0], c[1])):
        group = list(group)
        for this, following in zip(group, group[1:]):
            totals[this[0], this[3]] += following[2] - this[2]
    return dict(totals)


def path_counts(clicks):
    """(day, path) -> sessions; clicks are (day, session, timestamp, site)."""
    counts = Counter()
    for (day, _), group in groupby(sorted(clicks), key=lambda c: (c[0], c[1])):
        path = [site for site, _ in groupby(c[3] for c in group)]
        counts[day, tuple(path[:5])] += 1
    return dict(counts)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
