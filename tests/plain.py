"""The definitions in plain Python, for comparison on small inputs."""

from itertools import groupby


def chains(rows, gap):
    """Rows (device, value, time) as sessions: device and its rows by time."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[2], r[1]))
    for device, group in groupby(ordered, key=lambda r: r[0]):
        session = []
        for row in group:
            if session and row[2] - session[-1][2] > gap:
                yield device, session
                session = []
            session.append(row)
        yield device, session


def plain_sessions(rows, gap):
    return [
        (device, s[0][2], s[-1][2], sum(r[1] for r in s), len(s), s[-1][1])
        for device, s in chains(rows, gap)
    ]


def plain_running(rows, gap, every):
    found = []
    for device, session in chains(rows, gap):
        for i, row in enumerate(session):
            after = session[i + 1] if i + 1 < len(session) else None
            if after is None or after[2] // every != row[2] // every:
                so_far = session[: i + 1]
                total = sum(r[1] for r in so_far)
                found.append((device, session[0][2], row[2], total, i + 1, row[1]))
    return found
