"""Secret scans that link the parts of a credential.

Some spans are reported by their form alone: assigned values, access identifiers and long
hexadecimal runs. Weaker candidates, such as a short password, a mixed token, an account
name or an address, prove little alone and much together. Each part stands in a scope,
the paragraph around it, and parts of one scope that lie within ``REACH`` characters of
each other are linked by an interval join: identifiers with secrets, endpoints with both.
A weak identifier or secret is reported if a link gives it its counterpart, an endpoint
if it has an identifier and a secret.

Intervals are dealt into bins as wide as the reach, widened by half of it on either side:
two of them are within reach if they share a bin, and the first shared one counts. Spans
of a pattern don't overlap, so a bin holds a bounded number of them, whatever the text.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ready, same, settle, text_key, text_of

#: The patterns of the base kinds, their order, and the least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
BASE = tuple(LEAST)

#: Weak kinds follow the base kinds in this order.
IDENTIFIER, SECRET, ENDPOINT = WEAK = "identifier", "secret", "endpoint"
KINDS = (*BASE, *WEAK)
#: Labelled account names; group 2 is the name.
NAMED = (
    r"""\b(user_?name|user_?id|user|login|account_?id|account|client_?id|app_?id|tenant_?id|"""
    r"""access_?key_?id|access_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,})"""
)
#: Labelled secrets beside the base ones; group 2 is the value.
LABELLED = (
    r"""\b(pwd|pass|passphrase|passcode|auth|credential|private_?key|signature|bearer)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{4,})"""
)
#: A run that looks random if it mixes digits with letters of either case.
MIXED = r"[A-Za-z0-9+/_-]{20,}"
URL = (
    r"""\b(?:https?|ftp|sftp|ssh|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|s3)"""
    r"""://[^\x00-\x20"'<>]+"""
)
HOST = r"""\b(host|hostname|server|endpoint|base_?url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+(?::[0-9]+)?)"""
#: An account name and a password within an address.
USERINFO = r"""://([^\x00-\x20"'<>/:@]{2,}):([^\x00-\x20"'<>/@]{3,})@"""
#: A value of the base pattern that is too short for it is weak from here on.
SHORT = 4
#: A hexadecimal run is a secret to link with from this length on.
KEY_LENGTH = 32
BLANK_LINE = r"\n[\x20\x09\x0D]*\n"
REACH = 200

PARTS = "array<struct<kind:string,begin:bigint,end:bigint,scope:bigint,role:string>>"


def _any_case(pattern: str) -> str:
    return f"(?i:{pattern})"


def _gate(text: Column) -> Column:
    """Texts that may have a span to report; the others surely have none.

    A link needs an identifier, and those are labelled, in an address, or of base form.
    """
    value = "[A-Za-z0-9+/_.=-]{12}"
    base = [
        _any_case(ASSIGN.replace("[A-Za-z0-9+/_.=-]+", value)),
        ACCESS.replace("+", "{14}"),
        HEX.replace("+", "{16}"),
    ]
    named = NAMED.replace(r"\b", "(?<![A-Za-z0-9_])")  # not all regex engines' \b is ASCII
    return text.rlike("|".join(base)) | text.rlike(f"{_any_case(named)}|{USERINFO}")


def _compiled() -> dict[str, re.Pattern]:
    kind = re.ASCII
    return {
        "assign": re.compile(ASSIGN, kind | re.IGNORECASE),
        # Runs are maximal, so asking for their length at once finds the same ones.
        "access": re.compile(ACCESS.replace("+", "{14,}")),
        "hex": re.compile(HEX.replace("+", "{16,}")),
        "named": re.compile(NAMED, kind | re.IGNORECASE),
        "labelled": re.compile(LABELLED, kind | re.IGNORECASE),
        "mixed": re.compile(MIXED),
        "url": re.compile(URL, kind),
        "host": re.compile(HOST, kind | re.IGNORECASE),
        "userinfo": re.compile(USERINFO),
        "blank": re.compile(BLANK_LINE),
    }


def parts_of(text: str, patterns: dict[str, re.Pattern]) -> list[dict]:
    """All parts of one text by start, then kind: base spans and weak candidates."""
    spans, short = [], []
    for m in patterns["assign"].finditer(text):
        size = m.end(2) - m.start(2)
        if size >= LEAST["assign"]:
            spans.append((*m.span(), "assign", SECRET))
        elif size >= SHORT:
            short.append(m.span())
    spans += [(*m.span(), "access", IDENTIFIER) for m in patterns["access"].finditer(text)]
    for m in patterns["hex"].finditer(text):
        long = m.end() - m.start() >= KEY_LENGTH
        spans.append((*m.span(), "hex", SECRET if long else ""))
    starts, reach = [], []  # base spans by start, and how far those up to it go
    for begin, end, _, _ in sorted(spans):
        starts.append(begin)
        reach.append(max(end, reach[-1] if reach else 0))

    def free(begin: int, end: int) -> bool:
        i = bisect_right(starts, end - 1)
        return not i or reach[i - 1] <= begin

    weak = {(*s, SECRET) for s in short}
    weak |= {(*m.span(), SECRET) for m in patterns["labelled"].finditer(text)}
    weak |= {(*m.span(), IDENTIFIER) for m in patterns["named"].finditer(text)}
    for m in patterns["mixed"].finditer(text):
        run = m.group()
        if re.search("[0-9]", run) and re.search("[a-z]", run) and re.search("[A-Z]", run):
            weak.add((*m.span(), SECRET))
    for m in patterns["userinfo"].finditer(text):
        weak |= {(*m.span(1), IDENTIFIER), (*m.span(2), SECRET)}
    spans += [(b, e, kind, kind) for b, e, kind in weak if free(b, e)]
    found = {m.span() for p in ("url", "host") for m in patterns[p].finditer(text)}
    spans += [(b, e, ENDPOINT, ENDPOINT) for b, e in found]
    breaks = [m.start() for m in patterns["blank"].finditer(text)]
    order = {kind: i for i, kind in enumerate(KINDS)}
    return [
        {"kind": kind, "begin": b, "end": e, "scope": bisect_right(breaks, b), "role": role}
        for b, e, kind, role in sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))
    ]


def _parts(texts: pa.Array) -> pa.Array:
    patterns = _compiled()
    every = [parts_of(t, patterns) if t is not None else [] for t in texts.to_pylist()]
    kind = pa.struct(
        [
            ("kind", pa.string()),
            ("begin", pa.int64()),
            ("end", pa.int64()),
            ("scope", pa.int64()),
            ("role", pa.string()),
        ]
    )
    return pa.array(every, pa.list_(kind))


def scanned(documents: DataFrame) -> DataFrame:
    """``doc_id, key, parts`` for each row, written once. A null text is empty."""
    ready(documents.sparkSession)
    text = text_of(documents)
    asked = F.when(_gate(text), text)
    parts = F.arrow_udf(_parts, PARTS)(asked)
    rows = documents.select("doc_id", text_key(text).alias("key"), parts.alias("parts"))
    return settle(rows, "secret-parts")


def _binned(parts: DataFrame, role: str, name: str, reach: int) -> DataFrame:
    half = reach // 2
    low = F.floor((F.col("begin") - half) / reach)
    high = F.floor((F.col("end") + half) / reach)
    here = parts.where(F.col("role") == role).select(
        "doc_id", "key", "scope",
        F.struct("kind", "begin", "end").alias(name),
        low.alias(f"{name}_low"),
        F.explode(F.sequence(low, high)).alias("bin"),
    )
    return here


def _near(left: DataFrame, right: DataFrame, a: str, b: str, reach: int) -> DataFrame:
    """Pairs within reach in one scope, each once, by the first bin they share."""
    where = same(left, right, "doc_id") & (left["key"] == right["key"])
    where &= (left["scope"] == right["scope"]) & (left["bin"] == right["bin"])
    where &= left["bin"] == F.greatest(F.col(f"{a}_low"), F.col(f"{b}_low"))
    where &= F.col(f"{a}.begin") - F.col(f"{b}.end") <= reach
    where &= F.col(f"{b}.begin") - F.col(f"{a}.end") <= reach
    where &= (F.col(f"{a}.begin") != F.col(f"{b}.begin")) | (F.col(f"{a}.end") != F.col(f"{b}.end"))
    return left.join(right, where).select(
        left["doc_id"], left["key"], left["scope"], F.col(a), F.col(b)
    )


def links(found: DataFrame, reach: int = REACH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Linked parts of ``scanned`` rows as pairs of spans ``kind, begin, end``.

    Three tables ``doc_id, key, scope`` with ``identifier, secret``; ``endpoint,
    identifier``; ``endpoint, secret``. Rows of equal id and text count once.
    """
    texts = found.where(F.size("parts") > 0).dropDuplicates(["doc_id", "key"])
    parts = texts.select("doc_id", "key", F.explode("parts").alias("part")).select(
        "doc_id", "key", "part.*"
    )
    binned = {role: _binned(parts, role, role, reach) for role in WEAK}
    return tuple(
        _near(binned[a], binned[b], a, b, reach)
        for a, b in ((IDENTIFIER, SECRET), (ENDPOINT, IDENTIFIER), (ENDPOINT, SECRET))
    )


def reported(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak spans with their complementary parts: ``doc_id, key, span``, each once."""
    pairs, named, keyed = links(found, reach)
    ids = ["doc_id", "key"]
    whole = pairs.select(*ids, F.explode(F.array(IDENTIFIER, SECRET)).alias("span"))
    sides = named.select(*ids, F.col(ENDPOINT).alias("span"), F.lit(1).alias("side")).unionByName(
        keyed.select(*ids, F.col(ENDPOINT).alias("span"), F.lit(2).alias("side"))
    )
    both = sides.groupBy(*ids, "span").agg(F.min("side").alias("a"), F.max("side").alias("b"))
    ends = both.where(F.col("a") < F.col("b")).select(*ids, "span")
    weak = F.col("span.kind").isin(*WEAK)
    return whole.where(weak).unionByName(ends).distinct()


def scan(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: ``doc_id, base, spans`` as arrays of ``kind, begin, end``.

    ``base`` holds the spans of base kinds, ``spans`` also the weak ones that are linked;
    both by start, then kind, then end. Places count code points, ends are exclusive.
    """
    found = scanned(documents)
    weak = settle(
        reported(found, reach).groupBy("doc_id", "key").agg(F.collect_list("span").alias("weak")),
        "secret-links",
    )
    plain = F.transform(
        F.filter("parts", lambda p: p["kind"].isin(*BASE)),
        lambda p: F.struct(p["kind"].alias("kind"), p["begin"].alias("begin"), p["end"].alias("end")),
    )
    order = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    none = F.array().cast("array<struct<kind:string,begin:bigint,end:bigint>>")
    keyed = F.transform(
        F.concat(F.col("base"), F.coalesce("weak", none)),
        lambda s: F.struct(s["begin"], order[s["kind"]], s["end"], s["kind"].alias("kind")),
    )
    every = F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end")),
    )
    rows = found.select("doc_id", "key", plain.alias("base"))
    joined = rows.join(weak, same(rows, weak, "doc_id", "key"), "left")
    return joined.select(rows["doc_id"], "base", every.alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
    return F.array_join(one, ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
