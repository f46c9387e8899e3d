"""Plain versions of the corpus operators, by their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib

WHITE = re.compile(r"[\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def white_words(text: str | None) -> list[str]:
    return [w for w in WHITE.split(text or "") if w]


def bench_words(text: str | None) -> list[str]:
    return BENCH.findall((text or "").translate(LOWER))


def edit_distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def secrets(text: str | None) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Spans (start, rank, end) and the number of each base kind."""
    patterns = [(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8), (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)]
    spans, counts = [], []
    for rank, (pattern, group, least) in enumerate(patterns):
        own = [(m.start(), rank, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
        spans += own
        counts.append(len(own))
    return sorted(spans), counts


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    def ok(kind: str, value: str) -> bool:
        digits = re.sub(r"[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    return [(kind, m.start(), m.end()) for kind, p in patterns.items() for m in re.finditer(p, text or "") if ok(kind, m.group())]


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    words = white_words(text)
    lines = [x for x in (text or "").split("\n") if white_words(x)]
    places: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {p + j for at in places.values() if len(at) > 1 for p in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def contamination(text: str | None, items: list[tuple[int, str | None]], n: int = 10) -> tuple[int, int, list[int]]:
    words, hit, found = bench_words(text), set(), []
    for item, own in items:
        own = bench_words(own)
        m = min(n, len(own))
        windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        at = [i for i in range(len(words) - m + 1) if tuple(words[i : i + m]) in windows] if m else []
        hit |= {i + j for i in at for j in range(m)}
        found += [item] if at else []
    return len(words), len(hit), found


def repeats(docs: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple[int, int, str]]:
    first: dict[tuple, int] = {}
    for i, text in docs:
        words = white_words(text)
        for p in range(len(words) - length + 1):
            key = tuple(words[p : p + length])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in docs:
        words = white_words(text)
        gone = {p + j for p in range(len(words) - length + 1) if first[tuple(words[p : p + length])] < i for j in range(length)}
        out[i] = (len(words), len(gone), sha(" ".join(w for p, w in enumerate(words) if p not in gone)))
    return out


def removed_lines(docs: list[tuple[int, str | None]], threshold: float = 0.9) -> dict[int, list[int]]:
    earlier, out = [], {}
    for i, text in sorted(docs, key=lambda x: x[0]):
        out[i] = []
        for p, line in enumerate((text or "").split("\n")):
            own = {w for w in re.split(r"[ \t\n\r]+", line.lower()) if w}
            if own:
                if any(len(own & x) >= threshold * len(own | x) - 1e-9 for x in earlier):
                    out[i].append(p)
                earlier.append(own)
    return out


def pieces(ids: list[int], capacity: int = 2048) -> list[tuple[int, int, int, int]]:
    ids = [*ids, 0]
    cut = [(at, ids[at : at + capacity]) for at in range(0, len(ids), capacity)]
    return [(p, at, len(x), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x))) for p, (at, x) in enumerate(cut)]


def runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal stretch, by trying each period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((s, n, q) for (s, n), q in found.items())


def run_row(doc_id: int, text: str | None) -> tuple:
    words = white_words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *first, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def maximal_segments(scores: list[float], low: int = 0, high: int | None = None) -> list[tuple[int, int]]:
    """The segment with the greatest sum, then the same in what is left and right of it."""
    high = len(scores) if high is None else high
    best = max(((sum(scores[a:b]), a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    return [*maximal_segments(scores, low, best[1]), best[1:], *maximal_segments(scores, best[2], high)]


def trie(rows: list[tuple], head) -> list[tuple]:
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    turns = {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    rebuilt = {c: tuple(turns.get(c - c % 100, [])[: head(c)] + v[head(c) :]) for c, v in turns.items()}
    nodes: dict[tuple, list[int]] = {}
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    children: dict[tuple, int] = {}
    for v in nodes:
        if v:
            children[v[:-1]] = children.get(v[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for v, members in nodes.items():
        for d in range(len(v) + 1):
            leaves[v[:d]] += v not in children
            saved[v[:d]] += (len(members) - 1) * (len(v[-1][1]) if v else 0)
    out = []
    for v, members in nodes.items():
        ends = sha(",".join(map(str, sorted(c for c in members if rebuilt[c] == v))))
        out.append((min(members), len(v), min(nodes[v[:-1]]) if v else None, len(members), children.get(v, 0), leaves[v], saved[v], ends))
    return out
