"""Plain-Python versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

LOW = {i: i + 32 for i in range(65, 91)}
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOW))


def token_ids(texts):
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    every = tool.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], dtype="<u4") for e in every]


def crc(ids):
    return zlib.crc32(ids.tobytes())


def contamination(docs, items):
    """(doc_id, text) and (item_id, text) rows to (doc_id, n_words, n_hit, ids)."""
    spans = []
    for item_id, text in items:
        w = plain_words(text)
        size = min(13, len(w))
        spans += [(tuple(w[i : i + size]), item_id) for i in range(len(w) - size + 1) if size]
    sizes = {len(s) for s, _ in spans}
    by_span = {}
    for s, item_id in spans:
        by_span.setdefault(s, set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w = plain_words(text)
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = by_span.get(tuple(w[i : i + size]))
                if found is not None:
                    hit |= set(range(i, i + size))
                    ids |= found
        out.append((doc_id, len(w), len(hit), tuple(sorted(str(i) for i in ids if i is not None))))
    return out


def fingerprint(text):
    w = SPACED.findall((text or "").translate(LOW))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(prints, distance=2):
    """Group number of each fingerprint: the least place it is connected with."""
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def without_later_runs(docs, min_words):
    """(doc_id, text) rows in order of id, without later occurrences of repeated runs."""
    lines = {(d, i): SPACED.findall(x) for d, t in docs for i, x in enumerate((t or "").split("\n"))}
    seen, gone = {}, set()
    for d, t in docs:
        n = len((t or "").split("\n"))
        for first in range(n):
            for last in range(first, n):
                part = [lines[d, i] for i in range(first, last + 1)]
                if sum(map(len, part)) >= min_words:
                    key = tuple(map(tuple, part))
                    if key in seen and seen[key] != (d, first):
                        gone |= {(d, i) for i in range(first, last + 1)}
                    seen.setdefault(key, (d, first))
    return [
        (d, t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone))
        for d, t in docs
    ]


def base_counts(text):
    text = text or ""
    w = SPACED.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def license_scan(text, rules):
    w = plain_words(text)
    line = " " + " ".join(w) + " "
    spans = []
    for r in rules:
        for m in re.finditer(r.expression, line):
            first = line[: m.start()].count(" ") - 1
            spans.append((first, first + m.group().count(" "), r))

    def contained(a, b, r):
        return any(
            a2 <= a and b2 >= b and r2.priority <= r.priority
            and ((a2, b2) != (a, b) or (r2.priority, r2.number) < (r.priority, r.number))
            for a2, b2, r2 in spans
        )

    kept = [s for s in spans if s[2].priority == 0 or not contained(*s)]
    base = [a for a, _, r in kept if r.priority == 0]
    return (
        len(w),
        len(base),
        min(base, default=None),
        max(base, default=None),
        ",".join(sorted({r.label for _, _, r in kept if r.priority == 0})),
        ",".join(sorted({r.label for _, _, r in kept})),
        max((r.score for _, _, r in kept), default=0.0),
    )


BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged_rows(rows):
    """(conv_id, turn, role, text) rows after damage, in order, by conversation."""
    out = {c: [] for c, _, _, _ in rows}
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (c, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[c] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for v in out.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def repair(rows):
    """(turn, role, text) rows to gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        solid = BLANK.findall(text)
        kind = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
        faults.append(kind)
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    n = len(rows)
    # Cheapest, then least edits from row i on after a turn of initial q, by full strings.
    best = {("", n): (0, "", ()), ("s", n): (10**9, "", ()), ("u", n): (10**9, "", ()), ("a", n): (0, "", ())}
    for i in range(n, -1, -1):
        if i < n:
            _, role, text = rows[i]
            extra = 3 if faults[i] == "t" else 0
            for q in ("", "s", "u", "a"):
                c, s, kept = best[q, i + 1]
                options = [(c + 4, "D" + s, kept)]
                if faults[i] not in ("b", "d"):
                    if role[:1] and role[:1] in legal[q]:
                        c, s, kept = best[role[:1], i + 1]
                        options.append((c + extra, "K" + s, ((role, text), *kept)))
                    for to in ("user", "assistant"):
                        if to[0] in legal[q]:
                            c, s, kept = best[to[0], i + 1]
                            options.append((c + 3 + extra, "R" + s, ((to, text), *kept)))
                best[q, i] = min(options)
        for _ in range(3):
            for q in ("", "s", "u", "a"):
                for to in ("user", "assistant"):
                    if to[0] in legal[q]:
                        c, s, kept = best[to[0], i]
                        best[q, i] = min(best[q, i], (c + 3, "I" + s, ((to, ""), *kept)))
    cost, audit, kept = best["", 0]
    told = "\n".join(f"{r}:{t}" for r, t in kept)
    count = [faults.count(k) for k in "bdt"]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256(told.encode()).hexdigest())
