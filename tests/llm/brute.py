"""Plain versions of the operators, one row or one pair at a time."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def covered(starts: list[int], width: int) -> list[tuple[int, int]]:
    found: list[list[int]] = []
    for start in sorted(starts):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], start + width)
        else:
            found.append([start, start + width])
    return [tuple(span) for span in found]


def without(held, spans):
    rest, at = held[:0], 0
    for start, end in spans:
        rest, at = rest + held[at:start], end
    return rest + held[at:]


def repeats(docs: list[tuple], width: int = 200) -> Counter:
    bodies = [(doc_id, (text or "").encode()) for doc_id, text, *_ in docs]
    seen = Counter(b[i : i + width] for _, b in bodies for i in range(len(b) - width + 1))
    found = Counter()
    for doc_id, body in bodies:
        spans = covered([i for i in range(len(body) - width + 1) if seen[body[i : i + width]] > 1], width)
        rest = without(body, spans)
        found[doc_id, len(body), len(body) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()] += 1
    return found


def passages(docs: list[tuple], window: int = 13) -> Counter:
    least: dict[tuple, int] = {}
    number = lambda doc_id: float("inf") if doc_id is None else doc_id
    split = [(doc_id, (text or "").encode().split()) for doc_id, text, *_ in docs]
    for doc_id, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(least.get(key, float("inf")), number(doc_id))
    found = Counter()
    for doc_id, words in split:
        starts = [
            i for i in range(len(words) - window + 1) if least[tuple(words[i : i + window])] < number(doc_id)
        ]
        spans = covered(starts, window)
        rest = without(words, spans)
        digest = hashlib.sha256(b" ".join(rest)).hexdigest()
        found[doc_id, len(words), len(words) - len(rest), len(spans), digest] += 1
    return found


def shingle_set(text: str | None, length: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    length = min(length, len(words))
    return frozenset(tuple(words[i : i + length]) for i in range(len(words) - length + 1))


def near_components(docs: list[tuple], length: int) -> Counter:
    """Rows of one id count as linked."""
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(doc_id, shingle_set(text, length)) for doc_id, text, *_ in docs]
    for i, (a, left) in enumerate(sets):
        for b, right in sets[i + 1 :]:
            if None not in (a, b) and left and 100 * len(left & right) >= 80 * len(left | right):
                a_root, b_root = find(a), find(b)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return Counter(
        (a, len(held), None if a is None else find(a), a is None or find(a) == a) for a, held in sets
    )


def repeated_words(text: str | None, window: int = 5) -> int:
    words = (text or "").encode().split()
    places = defaultdict(list)
    for i in range(len(words) - window + 1):
        places[tuple(words[i : i + window])].append(i)
    starts = [i for held in places.values() if len(held) > 1 for i in held]
    return sum(end - start for start, end in covered(starts, window))
