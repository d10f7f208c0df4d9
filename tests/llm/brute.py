"""Plain-Python versions of what the queries return, written from their contracts."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE_RE = r"\x20"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and _luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15),
}
SECRETS = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: len(m.group(2)) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
}


def base_spans(text: str | None, kinds: dict) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, (rx, ok) in kinds.items() for m in re.finditer(rx, text or "") if ok(m)]


def spell(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def simhash(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[tuple[int | None, int]], radius: int = 3) -> list[int | None]:
    """Smallest id reachable over links of at most ``radius`` bits, by flood fill."""
    f = np.array([p for _, p in prints], dtype=np.uint64)
    out: list = [None] * len(f)
    done = np.zeros(len(f), bool)
    for i in range(len(f)):
        if done[i]:
            continue
        group, todo = [], [i]
        done[i] = True
        while todo:
            j = todo.pop()
            group.append(j)
            near = np.flatnonzero((np.bitwise_count(f ^ f[j]) <= radius) & ~done)
            done[near] = True
            todo += near.tolist()
        ids = [prints[j][0] for j in group if prints[j][0] is not None]
        for j in group:
            out[j] = min(ids, default=None)
    return out
