"""The registered pipeline end to end against its stages by brute force, piece by piece."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np

import __spark_entry__ as entry

WORDS = [f"word{i}" for i in range(300)]


def passage(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


ITEM = passage("item", 30)
SHARED = passage("shared", 60)
TEXTS = [
    (1, passage(1, 80) + "\n" + SHARED),
    (2, SHARED + "\n" + passage(2, 90)),  # loses the shared line
    (3, passage(3, 120)),
    (4, passage(3, 120)),  # a copy that line removal empties: one empty text stays
    (5, passage(5, 6000)),  # several pieces
    (6, passage(5, 6000)[:-5] + "other end"),
    (7, passage(7, 40) + " " + ITEM + " " + passage(8, 40)),  # contaminated
    (8, passage(9, 2000) + " " + ITEM),  # less than a twentieth
    (9, "123 %% .."),
    (10, None),
    (11, ""),
    (12, "é Straße ñ, kurz!"),
    *[(20 + i, passage(f"p{i}", random.Random(i).randrange(5, 400))) for i in range(12)],
]


def chained(docs, items):
    """(doc_id, text) rows to what the last stage packs, by text."""
    docs = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    docs = brute.without_later_runs(docs, 50)
    prints = [brute.fingerprint(t) for _, t in docs]
    docs = [x for i, (x, g) in enumerate(zip(docs, brute.linked(prints), strict=True)) if g == i]
    judged = brute.contamination(docs, items)
    return [x for x, (_, n, hit, _) in zip(docs, judged, strict=True) if not hit or 20 * hit < n]


def test_run_against_chained_stages(spark, tmp_path):
    rows = [(d, t, None, "s", len(t or "")) for d, t in TEXTS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, ITEM), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = chained(TEXTS, [(1, ITEM), (2, "")])
    assert {1, 3, 5, 8, 12} <= {d for d, _ in kept} and not {7, 9, 10, 11} & {d for d, _ in kept}
    want = Counter()
    for (d, _), ids in zip(kept, brute.token_ids([t for _, t in kept]), strict=True):
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[d, n, at, len(part), brute.crc(np.ascontiguousarray(part))] += 1
    got = entry.queries()["pipeline"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:]))
        assert sorted(parts)[0][0] == 0 and sum(n for _, n in parts) <= 4096
