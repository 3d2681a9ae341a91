"""Brute-force window model: one chain at a time, one event at a time."""

from collections import defaultdict

ORIGIN = 62_135_596_800


def bucket(t, size):
    return t - (t + ORIGIN) % size


def run_chain(times, size, lateness):
    """Late flags per event, windows in closing order, windows left open (whole seconds)."""
    late, closed, open_windows = [], [], defaultdict(list)
    watermark = closed_up_to = None
    for i, t in enumerate(times):
        watermark = t if watermark is None else max(watermark, t)
        end = bucket(t, size) + size
        is_late = closed_up_to is not None and end <= closed_up_to
        late.append(is_late)
        if not is_late:
            open_windows[end].append(i)
        for e in sorted(e for e in open_windows if e <= watermark - lateness):
            closed.append((e, open_windows.pop(e)))
            closed_up_to = e if closed_up_to is None else max(closed_up_to, e)
    return late, closed, dict(open_windows)


def random_times(rng, n):
    """Mostly rising times with jitter, stragglers and jumps."""
    now, out = 1_700_000_000 + rng.randrange(1000), []
    for _ in range(n):
        now += rng.choice([0, 1, 5, 20, 60, 200])
        out.append(now - rng.choice([0, 0, 0, 1, 10, 40, 100, 500, 3000]))
    return out
