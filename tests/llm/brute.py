"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(items, width: int) -> list[tuple]:
    return [tuple(items[i : i + width]) for i in range(max(1, len(items) - width + 1))] if items else []


def components(nodes, links) -> dict:
    """The smallest node that each one reaches."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(a: frozenset, b: frozenset, percent: int = 80) -> bool:
    if not a or not b or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    return 100 * len(a & b) >= percent * len(a | b)


def all_links(sets: dict) -> list[tuple]:
    keys = sorted(sets)
    return [(a, b) for i, a in enumerate(keys) for b in keys[:i] if similar(sets[a], sets[b])]


def near_duplicates(texts: dict, width: int) -> dict:
    sets = {i: frozenset(grams(WORD.findall((t or "").translate(LOWER)), width)) for i, t in texts.items()}
    found = components(sets, all_links(sets))
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def dropped_lines(texts: dict, width: int) -> dict:
    """Per id: the numbers of the lines that go."""
    places: dict[str, list] = {}
    for i in sorted(texts):
        for k, line in enumerate((texts[i] or "").split("\n")):
            if WORD.search(line):
                places.setdefault(line, []).append((i, k))
    lines = list(places)
    sets = {n: frozenset(grams(line, width)) for n, line in enumerate(lines)}
    of_line = components(sets, all_links(sets))
    groups: dict = {}
    for n, line in enumerate(lines):
        groups.setdefault(of_line[n], []).extend(places[line])
    gone: dict = {i: set() for i in texts}
    for group in groups.values():
        for i, k in sorted(group)[1:]:
            gone[i].add(k)
    return gone


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    times = Counter(grams(words, 3)) if len(words) > 2 else Counter()
    covered = {
        k + j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(3)
    }
    n_symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered)


def contaminated(texts: dict, items: dict, width: int = 5) -> dict:
    """(id, item): (start, shared) of the most similar window, the first of equals."""
    found = {}
    for i, text in texts.items():
        words = WORD.findall((text or "").lower())
        for item, content in items.items():
            wanted = WORD.findall((content or "").lower())
            if not wanted:
                continue
            size, own = len(wanted), Counter(grams(wanted, min(width, len(wanted))))
            if not own.keys() & set(grams(words, min(width, size))):
                continue
            total, best = sum(own.values()), None
            for start in range(len(words) - size + 1):
                window = Counter(grams(words[start : start + size], min(width, size)))
                shared = sum((own & window).values())
                if 100 * shared >= 80 * (2 * total - shared) and (best is None or shared > best[1]):
                    best = (start, shared)
            if best:
                found[i, item] = best
    return found


def repeats_removed(texts: list, window: int = 35) -> list[tuple]:
    """Per row: words, and those that are kept."""
    words = [WORD.findall(t or "") for t in texts]
    times = Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    result = []
    for w in words:
        gone = {
            s + k
            for s in range(len(w) - window + 1)
            if times[tuple(w[s : s + window])] > 1
            for k in range(window)
        }
        result.append((len(w), [x for k, x in enumerate(w) if k not in gone]))
    return result


def word_surprise(text: str, others: list[str], everything: list[str]) -> float:
    """The negative log probability of ``text`` by a Kneser-Ney model of order 3 of ``others``,
    with discounts and vocabulary of ``everything``."""
    from collections import Counter
    from math import log

    def trigrams(t):
        words = ["<", "<", *t.split(), ">"]
        return list(zip(words, words[1:], words[2:], strict=False))

    def counts(texts):
        three = Counter(g for t in texts for g in trigrams(t))
        two = Counter()
        for (_, b, c), n in three.items():
            two[b, c] += n if b == "<" else 1
        one = Counter((c,) for _, c in two)
        return one, two, three

    def discount(of):
        times = [sum(n == k for n in of.values()) for k in (1, 2, 3, 4)]
        y = times[0] / (times[0] + 2 * times[1]) if times[0] + times[1] else None
        return [0] + [
            max(0.1, min(k, k - (k + 1) * y * times[k] / times[k - 1])) if y is not None and times[k - 1] else 0.5 * k
            for k in (1, 2, 3)
        ]

    whole = counts(everything)
    discounts = [discount(of) for of in whole]

    def p(gram):
        below = p(gram[1:]) if len(gram) > 1 else 1 / (len(whole[0]) + 1)
        of, d = levels[len(gram) - 1], discounts[len(gram) - 1]
        context = [n for g, n in of.items() if g[:-1] == gram[:-1]]
        if not context:
            return below
        n = of[gram]
        back = sum(d[min(k, 3)] for k in context)
        return (n - d[min(n, 3)] + back * below) / sum(context)

    levels = counts(others)
    return -sum(log(p(g)) for g in trigrams(text))
