"""Plain-Python expectations, written from the definitions."""

import math
import random


def interpolated(values, p):
    ordered = sorted(values)
    rank = p * (len(ordered) - 1)
    low = math.floor(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (rank - low)


def nearest(values, p):
    return sorted(values)[max(0, math.ceil(len(values) * p) - 1)]


def keep_line(line):
    parts = line.split()
    try:
        numbers = [int(x) for x in parts]
    except ValueError:
        return None
    if len(numbers) < 6 or numbers[2] < 0 or numbers[2] > 60_000_000:
        return None
    return numbers[2], numbers[4]


def run_batch(balances, requests):
    state = dict(balances)
    for _, key, op, delta in sorted(requests):
        if op == "insert":
            state[key] = delta
        elif op == "delete":
            state.pop(key, None)
        elif op == "update" and key in state:
            state[key] += delta
    return state


def skewed_groups(seed, rows=4000):
    """Half of all rows in one group, one group of a single row."""
    rng = random.Random(seed)
    data = [("hot", rng.randrange(0, 60_000_001) if rng.random() < 0.5 else rng.randrange(100)) for _ in range(rows // 2)]
    data += [(f"g{rng.randrange(40)}", rng.randrange(0, 20_000)) for _ in range(rows // 2)]
    return data + [("one", 7)]
