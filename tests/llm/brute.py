"""Plain Python answers for the operators, and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").translate(_UPPER)


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed: int = 1) -> list[tuple]:
    """Copies, near copies, shared passages, a very long text, nulls, empty texts and a repeated row."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(20, 200), 3000) for _ in range(60)]
    passage = prose(rng, 30, 3000)
    for i in range(8):
        texts.append(edited(rng, texts[i], 1 + i // 2))
        texts.append(texts[i + 10])
        texts.append(f"{prose(rng, 20, 3000)} {passage} {prose(rng, 15, 3000)}")
    chain = prose(rng, 300, 3000)
    for _ in range(6):
        chain = edited(rng, chain, 6)
        texts.append(chain)
    texts += [None, "", " \t\n ", "one", "two words", "two words", "three little words", "a\x0bb\x0cc a", "É é Ñ", "w1 " * 40]
    texts.append(prose(rng, 30_000, 20_000))
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[3], (None, prose(rng, 30), None, None, None), (1000, texts[0], None, None, None)]


def near_groups(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id -> (set size, component) over rows with an id; ids repeat the text only."""
    sets = {}
    for doc_id, text, *_ in rows:
        words = WORD.findall(lower(text))
        if doc_id is not None:
            short = {tuple(words)} if words else set()
            sets[doc_id] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or short
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def substring(rows: list[tuple], window: int = 13) -> dict:
    first = {}
    for doc_id, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = WORD.findall(text or "")
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k : k + window]), doc_id)
    found = {}
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def bare_words(text) -> list:
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", lower(text))


def shingles(text, size: int = 5) -> set:
    words = bare_words(text)
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def contained(rows: list[tuple], items: list[tuple], percent: int = 80) -> set:
    """Items below five words are one shingle, of their own size."""
    holders, sets = defaultdict(list), []
    for n, (i, t) in enumerate(items):
        size = min(5, len(bare_words(t)))
        sets.append((i, size, shingles(t, size) if size else set()))
        for x in sets[-1][2]:
            holders[x].append(n)
    sizes = {size for _, size, s in sets if s}
    found = set()
    for doc_id, text, *_ in rows:
        own = [x for size in sizes for x in shingles(text, size)]
        for n, shared in Counter(n for x in own for n in holders[x]).items():
            if 100 * shared >= percent * len(sets[n][2]):
                found.add((doc_id, sets[n][0], len(sets[n][2]), shared))
    return found


def rules(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    number, covered = Counter(windows), [False] * len(words)
    for k, w in enumerate(windows):
        if number[w] > 1:
            covered[k : k + 3] = [True] * 3
    n, repeats = len(words), sum(covered)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, again, repeats, n < 50 or 100 * repeats > 50 * n


def base_secrets(text) -> str:
    text = text or ""
    names = "|".join("".join(f"[{c}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token"))
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    assign = rf"""({names}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
