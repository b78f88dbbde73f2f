"""The sequential rules in plain Python, to compare with."""

from __future__ import annotations

from wattledger.operators.skew import HotKeys


def cut_every(keys, width, until=5_000):
    """Cuts of the keys at every `width` arrival numbers."""
    return HotKeys(tuple((key, tuple(range(width, until, width))) for key in keys))


def slot_machine(rows, state=None):
    """`rows` of (slot, t, imp, exp) of one device; gives (class, previous accepted row)."""
    out = []
    for row in rows:
        if state is None:
            out.append(("FIRST", None))
            state = row
        elif row[0] == state[0]:
            out.append(("DUPLICATE", state))
        elif row[0] < state[0]:
            out.append(("LATE", state))
        else:
            out.append(("GAP" if row[0] > state[0] + 300 else "EMIT", state))
            state = row
    return out, state


def ct_machine(rows, state=None, interval=21600):
    """`rows` of (ts, sign, outcome) of one system; gives (swapped, checked)."""
    out = []
    for ts, sign, outcome in rows:
        if sign == 0:
            out.append((False, False))
            continue
        due = state is None or ts >= state[1]
        if due and outcome == "EQUAL":
            out.append((False, True))
            continue
        if due and outcome == "MISSING":
            if state is None:
                state = (False, ts + interval)
        elif due:
            state = ((1 if outcome == "POS" else -1) != sign, ts + interval)
        out.append((state[0], due))
    return out, state


def miss_machine(rows, expires=None, ttl=900):
    """`rows` of processing times of one device; gives whether each is reported."""
    out = []
    for at in rows:
        report = expires is None or at > expires
        if report:
            expires = at + ttl
        out.append(report)
    return out, expires
