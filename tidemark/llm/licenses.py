"""License scans with ordered signature rules, in DataFrame functions only.

Texts become words in lower case between single spaces. A keyword expression sorts
out most texts; for the others each rule is gated by a keyword of its own before its
expression runs. A rule's matches become word intervals by a running count of the
spaces before them. A detection is suppressed if an interval of the same or a higher
priority contains it (of equal intervals the first rule's stays); base phrases always
stay. Intervals are rows, so a text with many detections is sorted, not compared
pairwise, and only ids and numbers are shuffled.

The rules are the base phrases, the names of ``FAMILIES`` in each of the phrasings of
``PHRASES``, the notices, and the signatures of ``signatures``, which are written by hand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import ready, same, settle, text_key, text_of
from tidemark.llm.signatures import KINDS, SIGNATURES

#: Phrases whose places are counted, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: name: (keyword that every match holds, the name, its identifier), the latter two as
#: expressions over single-spaced words. A name ends in ``+`` if its label is another's.
FAMILIES = {
    "mit": ("mit", "mit", "mit"),
    "mit-0": ("mit", "mit (?:no attribution|0)", "mit 0"),
    "x11": ("x11", "x11", "x11"),
    "apache-1.1": ("apache", "apache(?: software)?(?: license)?(?: version)? v?1 1", "apache 1 1"),
    "apache-2": ("apache", "apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?", "apache 2 0"),
    "bsd-2": ("bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd 2 clause"),
    "bsd-3": ("bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    "bsd-4": ("bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    "isc": ("isc", "isc", "isc"),
    "gpl-2": ("gpl", "(?:gnu )?gpl(?: version)? v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    "gpl-2+": ("general public", "(?:gnu )?general public license(?: version)? v?2(?: 0)?", "gplv2"),
    "gpl-3": ("gpl", "(?:gnu )?gpl(?: version)? v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    "gpl-3+": ("general public", "(?:gnu )?general public license(?: version)? v?3(?: 0)?", "gplv3"),
    "lgpl-2.1": ("lgpl", "(?:gnu )?lgpl(?: version)? v?2(?: [01])?", "lgpl 2 1(?: only| or later)?"),
    "lgpl-2.1+": (
        "general public",
        "(?:gnu )?lesser general public license(?: version)? v?2(?: [01])?",
        "lgplv2",
    ),
    "lgpl-3": ("lgpl", "(?:gnu )?lgpl(?: version)? v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    "lgpl-3+": (
        "lesser general public",
        "(?:gnu )?lesser general public license(?: version)? v?3(?: 0)?",
        "lgplv3",
    ),
    "agpl-3": ("agpl", "(?:gnu )?agpl(?: version)? v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    "agpl-3+": (
        "affero general public",
        "(?:gnu )?affero general public license(?: version)? v?3(?: 0)?",
        "agplv3",
    ),
    "gfdl": ("gfdl", "(?:gnu )?gfdl(?: version)?(?: v?1 [123])?", "gfdl 1 [123]"),
    "gfdl+": ("free documentation", "(?:gnu )?free documentation(?: version)?", "fdl"),
    "mpl-1.1": ("mpl", "mpl(?: version)? v?1 [01]", "mpl 1 1"),
    "mpl-2": ("mpl", "mpl(?: version)? v?2(?: 0)?", "mpl 2 0"),
    "mpl-2+": ("mozilla public", "mozilla public license(?: version)? v?2(?: 0)?", "mplv2"),
    "epl-1": ("epl", "epl(?: version)? v?1(?: 0)?", "epl 1 0"),
    "epl-2": ("epl", "epl(?: version)? v?2(?: 0)?", "epl 2 0"),
    "epl-1+": ("eclipse public", "eclipse public license(?: version)? v?1(?: 0)?", "eplv1"),
    "epl-2+": ("eclipse public", "eclipse public license(?: version)? v?2(?: 0)?", "eplv2"),
    "cddl": ("cddl", "cddl(?: version)?(?: 1 [01])?", "cddl 1 [01]"),
    "cddl+": ("common development", "common development and distribution(?: 1 [01])?", "cddlv1"),
    "cpl": ("common public", "common public(?: license)?(?: version)?(?: 1 0)?", "cpl 1 0"),
    "eupl": ("eupl", "eupl(?: version)?(?: v?1 [012])?", "eupl 1 [012]"),
    "osl-3": ("open software", "open software(?: license)?(?: version)?(?: 3 0)?", "osl 3 0"),
    "afl-3": ("academic free", "academic free(?: license)?(?: version)?(?: 3 0)?", "afl 3 0"),
    "artistic": ("artistic", "artistic(?: [12] 0)?", "artistic [12] 0"),
    "cc0": ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    "cc-by": ("cc by", "cc by(?: [1234] [05])?", "cc by [1234] [05]"),
    "cc-by+": ("creative commons", "creative commons attribution(?: [1234] [05])?", "ccby"),
    "cc-by-sa": ("cc by sa", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]"),
    "cc-by-sa+": ("creative commons", "creative commons attribution share ?alike(?: [1234] [05])?", "ccbysa"),
    "cc-by-nd": ("cc by nd", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]"),
    "cc-by-nc": ("cc by nc", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]"),
    "cc-by-nc+": ("creative commons", "creative commons attribution non ?commercial(?: [1234] [05])?", "ccbync"),
    "cc-by-nd+": ("creative commons", "creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?", "ccbynd"),
    "cc-by-nc-sa+": ("creative commons", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?", "ccbyncsa"),
    "cc-by-nc-nd+": ("creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?", "ccbyncnd"),
    "cc-by-nc-sa": ("cc by nc sa", "cc by nc sa(?: [1234] [05])?", "cc by nc sa [1234] [05]"),
    "cc-by-nc-nd": ("cc by nc nd", "cc by nc nd(?: [1234] [05])?", "cc by nc nd [1234] [05]"),
    "unlicense": ("unlicense", "unlicense", "unlicense"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl"),
    "zlib": ("zlib", "zlib(?: libpng)?", "zlib"),
    "boost": ("boost software", "boost software(?: license)?(?: version)?(?: 1 0)?", "bsl 1 0"),
    "python": ("python software", "python software foundation", "psf 2 0"),
    "php": ("php", "php(?: license)?(?: version)? 3 (?:0|01)", "php 3 01"),
    "ofl": ("ofl", "(?:sil )?ofl(?: 1 [01])?", "ofl 1 [01]"),
    "ofl+": ("open font", "(?:sil )?open font", "silofl"),
    "odbl": ("odbl", "odbl(?: version)?(?: 1 0)?", "odbl 1 0"),
    "odbl+": ("open database", "open database(?: version)?(?: 1 0)?", "opendb"),
    "ms-pl": ("microsoft", "microsoft public", "ms pl"),
    "ms-rl": ("microsoft", "microsoft reciprocal", "ms rl"),
    "ncsa": ("ncsa", "(?:university of illinois )?ncsa", "ncsa"),
    "postgresql": ("postgresql", "postgresql", "postgresql"),
    "w3c": ("w3c", "w3c(?: software)?", "w3c"),
    "openssl": ("openssl", "openssl", "openssl"),
    "ecl-2": ("educational community", "educational community(?: license)?(?: version)?(?: 2 0)?", "ecl 2 0"),
    "upl": ("universal permissive", "universal permissive", "upl 1 0"),
    "busl": ("business source", "business source(?: license)?(?: 1 1)?", "busl 1 1"),
    "sspl": ("server side public", "server side public", "sspl 1 0"),
    "cecill": ("cecill", "cecill(?: [12] [01])?", "cecill 2 [01]"),
    "public-domain": ("public domain", "public domain", "public domain"),
}

#: (priority, score, expression with NAME or ID): smaller priorities win.
PHRASES = (
    (1, 1.0, "spdx licen[cs]e identifier ID"),
    (2, 0.95, "licen[cs]ed (?:to you )?under (?:(?:the|a|an|this) )?(?:terms of )?(?:(?:the|a|an|this) )?NAME(?: licen[cs]e)?"),
    (2, 0.95, "(?:released|distributed|available|published|provided|dedicated) (?:under|to|into) (?:(?:the|a|an|this) )?(?:terms of )?(?:(?:the|a|an|this) )?NAME(?: licen[cs]e)?"),
    (3, 0.9, "(?:terms|conditions) of (?:(?:the|a|an|this) )?NAME(?: licen[cs]e)?"),
    (3, 0.85, "(?:subject to|governed by|under) (?:(?:the|a|an|this) )?NAME licen[cs]e"),
    (3, 0.85, "dual licen[cs]ed (?:under )?(?:the )?NAME(?: licen[cs]e)?"),
    (4, 0.8, "NAME licen[cs]e"),
)

#: Notices that are no license of their own.
NOTICES = (
    ("all-rights-reserved", "reserved", "(?:all|no) rights reserved", 4, 0.6),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 4, 0.4),
    ("proprietary", "proprietary", "proprietary and confidential", 4, 0.7),
)

PRIORITIES = (1, 2, 3, 4)

#: Keyword of the phrase with an identifier, which need not hold the name's.
SPDX = "spdx licen"

#: Every phrasing holds a word that starts like one of these, every name its keyword. A
#: signature whose keyword has no such word is looked for by its keyword alone.
VERBS = (
    "licence", "license", "released", "distributed", "available", "published", "provided",
    "dedicated", "terms", "conditions",
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts.
SEPARATORS = "".join(
    chr(c) for c in range(128) if chr(c) not in "0123456789abcdefghijklmnopqrstuvwxyz" + UPPER
)
#: Signs that no word holds, around a rule's matches.
OPEN, SHUT = "\x01", "\x02"


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    keyword: str
    expression: str
    priority: int
    score: float


def rules() -> list[Rule]:
    """Base phrases first (priority 0), then all other rules in order."""
    found = [(label, phrase, phrase, 0, 1.0) for phrase, label in BASE.items()]
    for name, (keyword, pattern, identifier) in FAMILIES.items():
        for priority, score, phrase in PHRASES:
            text = phrase.replace("NAME", pattern).replace("ID", identifier)
            own = SPDX if phrase.endswith(" ID") else keyword
            found.append((name.removesuffix("+"), own, text, priority, score))
    found += [(label, kw, text, p, s) for label, kw, text, p, s in NOTICES]
    found += [
        (label, kw, text, *KINDS[kind])
        for label, signatures in SIGNATURES.items()
        for kw, text, kind in signatures
    ]
    return [
        Rule(i, label, kw, f"(?<= )(?:{text})(?= )", priority, score)
        for i, (label, kw, text, priority, score) in enumerate(found)
    ]


def _choice(words: set[str]) -> str:
    """An expression for any of the words, tried letter by letter."""
    if "" in words:  # nothing longer is needed to find one
        return ""
    heads = sorted({w[0] for w in words})
    ways = [h + _choice({w[1:] for w in words if w[0] == h}) for h in heads]
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def _gate(line: Column) -> Column:
    """Lines that may hold a match; the others surely hold none. Keywords start words."""
    own = {keyword for signatures in SIGNATURES.values() for keyword, _, _ in signatures}
    worded = {keyword for keyword in own if any(verb[:5] in keyword for verb in VERBS)}
    names = {keyword for keyword, _, _ in FAMILIES.values()} | worded | {SPDX}
    alone = {keyword for _, keyword, _, _, _ in NOTICES} | {"cc by nc"} | (own - worded)
    verbs = line.rlike(" " + _choice(set(VERBS)))
    return line.rlike(" " + _choice(alone)) | (verbs & line.rlike(" " + _choice(names)))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matched(every: list[Rule]) -> Column:
    """The rules that match ``line``, with the spaces in each stretch of it: before the
    first match, in it, after it, and so on.

    Expressions are literals, compiled once, and stand behind their keywords. ``filter``
    has its argument interpreted, so their number makes no generated code.
    """
    groups: dict[str, list[str]] = {}
    for r in every:
        marked = f"regexp_replace(line, r'{r.expression}', '{OPEN}$0{SHUT}')"
        stretches = f"split({marked}, '[{OPEN}{SHUT}]')"
        rule = (
            f"named_struct('number', {r.number}, 'label', '{r.label}', 'priority', {r.priority},"
            f" 'score', {r.score}D, 'spaces',"
            f" transform({stretches}, x -> length(x) - length(replace(x, ' ', ''))))"
        )
        groups.setdefault(r.keyword, []).append(f"if(line rlike r'{r.expression}', {rule}, null)")
    by_keyword = [
        f"if(contains(line, '{keyword}'), array({', '.join(some)}), null)" for keyword, some in groups.items()
    ]
    asked = f"flatten(filter(array({', '.join(by_keyword)}), g -> g is not null))"
    return F.expr(f"filter({asked}, h -> h is not null)")


def matched(documents: DataFrame, every: list[Rule] | None = None) -> DataFrame:
    """``doc_id, key, n_words, hits`` for each row, in one pass, written once.

    A null text has no words. ``hits`` is null where no keyword lets a rule be tried.
    """
    ready(documents.sparkSession)
    plain = F.translate(
        text_of(documents), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS)
    )
    words = documents.select(
        "doc_id",
        text_key(text_of(documents)).alias("key"),
        F.trim(F.regexp_replace(plain, "  +", " ")).alias("words"),
    )
    lines = words.select(
        "doc_id",
        "key",
        F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1).cast("long").alias("n_words"),
        F.concat(F.lit(" "), "words", F.lit(" ")).alias("line"),
    )
    hits = F.when(_gate(F.col("line")), _matched(every or rules()))
    return settle(lines.select("doc_id", "key", "n_words", hits.alias("hits")), "license-hits")


def detections(found: DataFrame) -> DataFrame:
    """Matches of ``matched`` rows: ``doc_id, key, number, label, priority, score, first, last``.

    ``first`` and ``last`` are word places, from 0. Rows of equal id and text count once.
    """
    texts = found.where(F.size("hits") > 0).dropDuplicates(["doc_id", "key"])
    hits = texts.select("doc_id", "key", F.explode("hits").alias("h")).select("doc_id", "key", "h.*")
    stretches = hits.select(
        "doc_id", "key", "number", "label", "priority", "score", F.posexplode("spaces").alias("nth", "own")
    )
    order = Window.partitionBy("doc_id", "key", "number").orderBy("nth")
    placed = stretches.withColumn("last", F.sum("own").over(order) - 1).where(F.col("nth") % 2 == 1)
    return placed.select(
        "doc_id", "key", "number", "label", "priority", "score",
        (F.col("last") - F.col("own")).alias("first"), "last",
    )


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections that no interval of the same or a higher priority contains."""
    order = (
        Window.partitionBy("doc_id", "key")
        .orderBy("first", F.desc("last"), "priority", "number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.lit(None).cast("long")
    for p in PRIORITIES:
        upto = F.max(F.when(F.col("priority") <= p, F.col("last"))).over(order)
        reach = F.when(F.col("priority") == p, upto).otherwise(reach)
    return found.withColumn("reach", F.coalesce(reach, F.lit(-1))).where(
        (F.col("priority") == 0) | (F.col("reach") < F.col("last"))
    ).drop("reach")


def scan(documents: DataFrame) -> DataFrame:
    """One row per document: words, base places and labels, all labels, score.

    A null text has no words. The score is that of the surest detection, else 0.
    """
    every = matched(documents)
    found = settle(unsuppressed(detections(every)), "licenses")
    base = F.col("priority") == 0
    listed = F.array_join(F.array_sort(F.collect_set("label")), ",")
    of_base = F.collect_set(F.when(base, F.col("label")))
    per_text = found.groupBy("doc_id", "key").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(of_base), ",").alias("base_labels"),
        listed.alias("labels"),
        F.max("score").alias("score"),
    )
    return every.join(per_text, same(every, per_text, "doc_id", "key"), "left").select(
        every["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
