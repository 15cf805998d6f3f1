"""Plain version of the conversation repair: every edit tried by a search over (cost, audit)."""

import hashlib
import heapq
import re
import zlib


def damaged(rows):
    """rows: (conv_id, turn, role, text) -> the rows after damage."""
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text, h = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub(r"[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def key_of(conv, role, text):
    name = "" if conv is None else f"c{conv}"
    return hashlib.md5("|".join([str(len(name)), name, str(len(role)), role, text]).encode()).digest()


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def follows(state, role):
    """The pattern's state after a row of the role's initial, or None."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role[:1]))


def cheapest(rows, found):
    """(cost, audit, repaired) by uniform-cost search; ties by the audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (i, state) in done:
            continue
        done.add((i, state))
        if (to := follows(state, "user")) or (to := follows(state, "assistant")):
            heapq.heappush(heap, (cost + 2, audit + "I", i, to, out + (({"u": "user", "a": "assistant"}[to], ""),)))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if found[i] in ("blank", "duplicate"):
            continue
        more = cost + (found[i] == "truncated")
        for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
            if to := follows(state, name):
                heapq.heappush(heap, (more + price, audit + letter, i + 1, to, out + ((name, text),)))


def repair(rows, asked):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)."""
    groups = {c: [] for c in asked}
    for r in rows:
        groups[r[0]].append(r)
    result = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], key_of(*(r[0], r[2], r[3]))))
        found = faults(own)
        cost, audit, out = cheapest(own, found)
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        result[conv] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
                        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return result
