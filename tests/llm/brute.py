"""Plain versions of the text operators' contracts, one document at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WS = r"[^\x20\x09-\x0D]+"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text: str | None) -> int:
    words = re.findall(WS, lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps: list[int], bits: int = 3) -> list[int]:
    """For each fingerprint the place of the first one it is linked with."""
    different = sorted(set(fps))
    parent = {f: f for f in different}

    def root(f: int) -> int:
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(different):
        for b in different[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    first: dict[int, int] = {}
    for k, f in enumerate(fps):
        first.setdefault(root(f), k)
    return [first[root(f)] for f in fps]


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def decontaminate(docs: list[str | None], items: list[tuple[str, str | None]], n: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                owners = windows.get(tuple(w[i : i + size]))
                if owners:
                    hit |= set(range(i, i + size))
                    found |= owners
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def suffix(docs: list[str | None], length: int = 200) -> list[tuple]:
    data = [(t or "").encode() for t in docs]
    count: Counter = Counter()
    for d in data:
        for i in range(len(d) - length + 1):
            count[xxhash.xxh128_digest(d[i : i + length])] += 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[xxhash.xxh128_digest(d[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lines(docs: list[tuple[int, str | None]], least: int = 10) -> list[tuple]:
    ws = " \t\n\x0b\x0c\r"
    first: dict[str, int] = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            k = lower(line.strip(ws))
            first[k] = min(i, first.get(k, i))
    out = []
    for i, t in docs:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(k := lower(x.strip(ws))) < least or first[k] == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return out


def quality(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(WS, text)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if re.search(WS, line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), failed


def crc32_of(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
