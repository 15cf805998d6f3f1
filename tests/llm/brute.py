"""Plain versions of the operators, to compare with."""

import hashlib
import re


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_classes(texts, threshold=0.8):
    """class by id: least id of the component of equal or similar texts."""
    ids = sorted(texts)
    sets, root = {i: shingles(texts[i]) for i in ids}, {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            if y < x:
                a, b = sets[x], sets[y]
                shared = len(a & b)
                if words(texts[x]) == words(texts[y]) or shared and shared >= threshold * (len(a) + len(b) - shared):
                    p, q = find(x), find(y)
                    root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


KINDS = ("email", "ip", "card", "phone")
RULES = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
