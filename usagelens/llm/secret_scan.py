"""Secret scan: known shapes plus sliding-window entropy, all in DataFrame functions.

*Base* spans are the leftmost non-overlapping matches of three fixed patterns
(kinds ``assign``, ``access``, ``hex``), those that are too short dropped.  The
method adds spans: a candidate is a maximal run of token characters of at least
``WINDOW`` characters that holds a digit; a window of ``WINDOW`` characters
slides over it.  The accumulator keeps the count of every character in the window
and, in whole numbers, the sum that its Shannon entropy follows from; a step changes
only the counts and terms of the character that leaves and the one that enters.  The span from the first to the
last window above the threshold of the candidate's character class is reported
(kinds ``entropy_hex``, ``entropy_alnum``, ``entropy_b64``), unless the candidate
matches the allow-list or the span lies inside a base span.

A key, a path or a slash may be glued to a value.  With ``pieces`` each value is
judged by itself: class, threshold and allow-list are applied to every maximal
run of hexadecimal digits, every maximal run of letters and digits, and every
candidate, which ends where an allow-listed neighbour (``NEIGHBOUR``) stands as a
word of its own.  A span inside a base span or inside another added one is left out.

Positions are code points, end exclusive.  A regex's positions come from the
lengths of the pieces between its matches (``split``) and of the matches
(``regexp_extract_all``), so no Python runs.

Defined cases: a null text counts as empty and has no spans; null and repeated
ids stay as they are, one output row an input row; all other columns are left
out of the scan and passed on by ``redact``.  Texts are scanned whole, in time that grows
in proportion to their length (n log n for sorting many spans): characters are read
by index from an array, lists grow in blocks, and masking works on blocks of
characters.  One task holds a text, its candidates' characters as arrays (about 100
bytes a character of the longest candidate) and its spans; a text must fit there.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import unused

#: Fixed patterns of the base kinds, in their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the whole run: 20 characters or more
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: (kind, alphabet of the whole candidate, least bits a character in a window)
CLASSES = (
    ("entropy_hex", r"^[0-9A-Fa-f]+$", 3.0),
    ("entropy_alnum", r"^[0-9A-Za-z]+$", 3.5),
    ("entropy_b64", r"^.*$", 3.7),
)
KINDS = BASE_KINDS + tuple(c[0] for c in CLASSES)
#: Candidates that are no secrets: UUIDs, dates and times, documented examples, rows of one sign, counting sequences.
ALLOW = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^(?=[0-9TZ_=/+-]*$).*?(19|20)[0-9]{2}[-/][0-9]{2}[-/][0-9]{2}",
    r"(?i)example|sample|placeholder|dummy|xxxx",
    r"(.)\1{9}",
    r"(?i)0123456789|123456789|abcdefgh|qwertyui",
    r"^[0-9+/_=-]+$",
)
#: Pieces of a candidate with a class of their own (rank in KINDS: those of CLASSES).
HEX_PIECE = rf"[0-9A-Fa-f]{{{WINDOW},}}"
ALNUM_PIECE = rf"[0-9A-Za-z]{{{WINDOW},}}"
#: Allow-listed words and UUIDs between joiners or ends: they say nothing of what they are glued to.
NEIGHBOUR = (
    r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    r"|(?i:(?:example|sample|placeholder|dummy)[a-z]*|x{4,}))(?![0-9A-Za-z])"
)
#: Neighbours are matched too, so that no candidate starts within one; the allow-list or their length drops them.
CUT_CANDIDATE = rf"(?=[A-Za-z0-9+/_=-]{{{WINDOW}}})(?:{NEIGHBOUR}|(?:(?!{NEIGHBOUR})[A-Za-z0-9+/_=-]){{{WINDOW},}}+)"
#: Array elements that are appended to one list; longer lists are lists of such blocks.
_BLOCK = 256
#: Characters of a block when a text is masked.
_TEXT_BLOCK = 1024
#: A window's sum of c log2 c is kept in whole units of this size: no drift, however long the candidate.
_UNIT = 2.0**-40
#: Bits of one character's count, and counts in a 64-bit word.
_BITS = 7
_PER_WORD = 9
MASK = "[SECRET]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scanned(items: Column, start: Column, step: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], out_type: str) -> Column:
    """array<out_type>: for each item in turn, ``out(state, item)``, and the state becomes ``step(state, item)``.

    The list is made in blocks, so that its length costs no more than itself."""
    none, blocks_of = F.array().cast(f"array<{out_type}>"), F.array().cast(f"array<array<{out_type}>>")

    def block(state: Column, b: Column) -> Column:
        return F.aggregate(
            F.slice(items, b * _BLOCK + 1, _BLOCK),
            F.struct(state.alias("s"), none.alias("out")),
            lambda acc, x: F.struct(step(acc["s"], x).alias("s"), F.concat(acc["out"], F.array(out(acc["s"], x))).alias("out")),
        )

    blocks = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int")),
        F.struct(start.alias("s"), blocks_of.alias("out")),
        lambda acc, b: _let(block(acc["s"], b), lambda r: F.struct(r["s"].alias("s"), F.concat(acc["out"], F.array(r["out"])).alias("out"))),
    )
    return F.when(F.size(items) > 0, F.flatten(blocks["out"])).otherwise(none)


def _running(pieces: Column) -> Column:
    """Start of each match from array<struct<gap, size>>."""
    return _scanned(pieces, F.lit(0), lambda at, x: at + x["gap"] + x["size"], lambda at, x: at + x["gap"], "int")


def _matches(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Add ``out``: array<struct<start, hit>> of the pattern's matches (null where there is none)."""
    found = F.col(text).rlike(pattern)
    df = df.withColumn(f"{out}_hit", F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(f"{out}_gap", F.when(F.col(f"{out}_hit").isNotNull(), F.split(F.col(text), pattern, -1)))
    pieces = F.zip_with(
        f"{out}_hit",
        F.slice(f"{out}_gap", F.lit(1), F.size(f"{out}_hit")),
        lambda h, g: F.struct(F.length(g).alias("gap"), F.length(h).alias("size")),
    )
    df = df.withColumn(f"{out}_pos", F.when(F.col(f"{out}_hit").isNotNull(), pieces))
    df = df.withColumn(f"{out}_pos", F.when(F.col(f"{out}_pos").isNotNull(), _running(F.col(f"{out}_pos"))))
    both = F.zip_with(f"{out}_pos", f"{out}_hit", lambda p, h: F.struct(p.alias("start"), h.alias("hit")))
    return df.withColumn(out, both).drop(f"{out}_hit", f"{out}_gap", f"{out}_pos")


def _span(start: Column, rank: Column | int, end: Column) -> Column:
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return F.struct(start.cast("int").alias("start"), rank.cast("int").alias("rank"), end.cast("int").alias("end"))


def _spans(found: str, rank: int) -> Column:
    """Spans of one kind: every match, without those marked too short."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.coalesce(F.transform(found, lambda x: _span(x["start"], rank, x["start"] + F.length(x["hit"]))), none)


def _hot_windows(hit: Column, least: Column) -> Column:
    """struct<lo, hi>: first character of the first and end of the last window with enough entropy (lo -1: none).

    With counts c over the window, entropy is log2(W) - sum(c log2 c) / W; each
    step changes the sum by the terms of the leaving and the entering character."""
    term = F.lit([round(c * math.log2(c) / _UNIT) if c else 0 for c in range(WINDOW + 1)])
    most = (F.log2(F.lit(float(WINDOW))) - least) * F.lit(float(WINDOW))  # the sum may not be larger

    def swept(codes: Column, words: Column, largest: Column) -> Column:
        """``codes``: for each character the word, bit and unit of its count in the packed counts."""
        read = lambda counts, code: F.call_function("shiftright", F.get(counts, code["word"]), code["bit"]).bitwiseAND(F.lit(2**_BITS - 1)).cast("int")

        def step(acc: Column, i: Column) -> Column:
            enters, leaves = F.get(codes, i), F.get(codes, i - WINDOW)
            full = i >= WINDOW
            same = full & (leaves["word"] == enters["word"]) & (leaves["bit"] == enters["bit"])
            left, there = read(acc["counts"], leaves), read(acc["counts"], enters)
            total = acc["sum"] - F.get(term, left) + F.get(term, left - 1)
            total = F.when(full, total).otherwise(acc["sum"]) + F.get(term, there + 1) - F.get(term, there)
            changed = lambda c, j: c + F.when(j == enters["word"], enters["unit"]).otherwise(F.lit(0)) - F.when(full & (j == leaves["word"]), leaves["unit"]).otherwise(F.lit(0))
            return F.struct(
                F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], changed)).alias("counts"),
                F.when(same, acc["sum"]).otherwise(total).alias("sum"),
                acc["lo"].alias("lo"),
                acc["hi"].alias("hi"),
            )

        def judged(acc: Column, i: Column) -> Column:
            hot = (i >= WINDOW - 1) & (acc["sum"] <= largest)
            return F.struct(
                acc["counts"].alias("counts"),
                acc["sum"].alias("sum"),
                F.when(hot & (acc["lo"] < 0), i - WINDOW + 1).otherwise(acc["lo"]).alias("lo"),
                F.when(hot, i + 1).otherwise(acc["hi"]).alias("hi"),
            )

        none = F.struct(F.array_repeat(F.lit(0).cast("long"), words).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))
        stepped = lambda acc, i: _let(step(acc, i), lambda moved: judged(moved, i))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), none, stepped, lambda acc: F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi")))

    def place(signs: Column) -> Callable[[Column], Column]:
        def of(c: Column) -> Column:
            at = F.array_position(signs, c) - 1
            bit = (at % _PER_WORD * _BITS).cast("int")
            return F.struct(F.floor(at / _PER_WORD).cast("int").alias("word"), bit.alias("bit"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("unit"))

        return of

    # bound one by one, so that nothing is computed again at every step
    return _let(
        F.slice(F.split(hit, ""), F.lit(1), F.length(hit)),
        lambda chars: _let(
            F.array_distinct(chars),
            lambda signs: _let(
                F.transform(chars, place(signs)),
                lambda codes: _let(F.floor((most + 1e-9) / _UNIT), lambda largest: swept(codes, F.ceil(F.size(signs) / _PER_WORD).cast("int"), largest)),
            ),
        ),
    )


def scan(df: DataFrame, text_col: str = "text", out: str = "secret_spans", allow: tuple[str, ...] = ALLOW, pieces: bool = False) -> DataFrame:
    """Add ``out``: array<struct<start, rank, end>> sorted by start, then kind; ``KINDS[rank]`` names the kind."""
    mark = unused(df, "_scan")
    text = f"{mark}_text"
    df = df.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    found |= {"hexes": HEX_PIECE, "alnums": ALNUM_PIECE, "candidate": CUT_CANDIDATE} if pieces else {"candidate": CANDIDATE}
    names = {k: f"{mark}_{k}" for k in found}
    for kind, pattern in found.items():
        df = _matches(df, text, pattern, names[kind])
    long_enough = F.filter(names["assign"], lambda x: F.length(F.regexp_extract(x["hit"], f"^{ASSIGN}$", 2)) >= ASSIGN_LEAST)
    df = df.withColumn(names["assign"], long_enough)
    base = F.concat(*[_spans(names[k], i) for i, k in enumerate(BASE_KINDS)])
    df = df.withColumn(f"{mark}_base", F.array_sort(base))

    def suspicious(x: Column) -> Column:
        keep = x["hit"].rlike("[0-9]")
        for pattern in allow:
            keep &= ~x["hit"].rlike(pattern)
        return keep

    def judged(x: Column) -> Column:
        rank = F.lit(len(KINDS) - 1)
        least = F.lit(CLASSES[-1][2])
        for i, (_, alphabet, bits) in reversed(list(enumerate(CLASSES[:-1]))):
            fits = x["hit"].rlike(alphabet)
            rank = F.when(fits, F.lit(len(BASE_KINDS) + i)).otherwise(rank)
            least = F.when(fits, F.lit(bits)).otherwise(least)
        return F.struct(x["start"].alias("start"), rank.alias("rank"), _hot_windows(x["hit"], least).alias("hot"))

    no_spans = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def added(name: str, judge: Callable[[Column], Column]) -> Column:
        hot = F.filter(F.transform(F.filter(names[name], lambda x: judge(x) & suspicious(x)), judged), lambda x: x["hot"]["lo"] >= 0)
        return F.coalesce(F.transform(hot, lambda x: _span(x["start"] + x["hot"]["lo"], x["rank"], x["start"] + x["hot"]["hi"])), no_spans)

    if pieces:  # each piece in the narrowest class it fits
        (_, hexes, _), (_, alnums, _) = CLASSES[:2]
        all_added = F.concat(
            added("hexes", lambda x: F.lit(True)),
            added("alnums", lambda x: ~x["hit"].rlike(hexes)),
            added("candidate", lambda x: (F.length(x["hit"]) >= WINDOW) & ~x["hit"].rlike(alnums)),
        )
        df = df.withColumn(f"{mark}_hot", all_added)
    else:
        df = df.withColumn(f"{mark}_hot", added("candidate", lambda x: F.lit(True)))
    # in this order a span lies inside an earlier one (base, or added and of a narrower class) if one of those ends no sooner
    by_width = F.transform(F.concat(f"{mark}_base", f"{mark}_hot"), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["rank"].alias("rank")))
    df = df.withColumn(f"{mark}_hot", F.when(F.size(f"{mark}_hot") > 0, F.array_sort(by_width)).otherwise(F.array().cast("array<struct<start:int,back:int,rank:int>>")))
    end = lambda x: -x["back"]
    kept = _scanned(
        F.col(f"{mark}_hot"), F.lit(-1), lambda far, x: F.greatest(far, end(x)), lambda far, x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), end(x).alias("end"), (far < end(x)).alias("new")),
        "struct<start:int,rank:int,end:int,new:boolean>",
    )
    new = F.transform(F.filter(kept, lambda x: x["new"] & (x["rank"] >= len(BASE_KINDS))), lambda x: _span(x["start"], x["rank"], x["end"]))
    df = df.withColumn(out, F.array_sort(F.concat(f"{mark}_base", new)))
    return df.drop(text, f"{mark}_base", f"{mark}_hot", *names.values())


def spelled(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def redact(df: DataFrame, text_col: str = "text", mask: str = MASK, allow: tuple[str, ...] = ALLOW, pieces: bool = False) -> DataFrame:
    """Replace every span (overlapping ones together) of ``text_col`` by ``mask``; other columns and clean texts stay."""
    spans = unused(df, "_spans")
    found = scan(df, text_col, spans, allow, pieces)
    bounds, starts, merged, blocks = (f"{spans}_{x}" for x in ("bounds", "starts", "merged", "blocks"))
    # spans that overlap are one: it ends at the last end seen before a span that starts there or later
    seen = lambda far, x: F.struct(x["start"].alias("start"), far.alias("far"), x["end"].alias("end"))
    found = found.withColumn(bounds, _scanned(F.col(spans), F.lit(0), lambda far, x: F.greatest(far, x["end"]), seen, "struct<start:int,far:int,end:int>"))
    found = found.withColumn(starts, F.filter(bounds, lambda x: x["start"] >= x["far"]))
    ends = F.concat(F.transform(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda x: x["far"]), F.array(F.array_max(F.transform(bounds, lambda x: x["end"]))))
    found = found.withColumn(merged, F.when(F.size(spans) > 0, F.zip_with(starts, ends, lambda x, e: F.struct(x["start"].alias("start"), e.alias("end")))))
    found = found.withColumn(blocks, F.when(F.size(spans) > 0, F.regexp_extract_all(text_col, F.lit(f"(?s).{{1,{_TEXT_BLOCK}}}"), F.lit(0))))

    def first_open(at: Column) -> Column:
        """How many merged spans end at or before ``at``, by halving."""
        half = lambda acc: F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        step = lambda acc, _: F.when(acc["lo"] >= acc["hi"], acc).otherwise(
            F.when(F.get(F.col(merged), half(acc))["end"] <= at, F.struct((half(acc) + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), half(acc).alias("hi")))
        )
        return F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("lo"), F.size(merged).alias("hi")), step, lambda acc: acc["lo"])

    def masked(block: Column, b: Column) -> Column:
        """A block without its masked characters; the mask stands where a span starts."""
        begin = (b * _TEXT_BLOCK).cast("int")
        stop = begin + F.length(block)

        def cut(here: Column) -> Column:
            pieces_ = F.transform(
                here,
                lambda x, i: F.concat(
                    F.substr(block, _end_before(here, i, begin) - begin + 1, F.greatest(x["start"] - _end_before(here, i, begin), F.lit(0))), F.when(x["start"] >= begin, F.lit(mask)).otherwise(F.lit(""))
                ),
            )
            tail = F.greatest(F.element_at(here, -1)["end"] - begin, F.lit(0))
            return F.concat(F.array_join(pieces_, ""), F.substr(block, tail + 1))

        from_ = first_open(begin)
        inside = _let(from_, lambda p: F.filter(F.slice(merged, p + 1, _TEXT_BLOCK), lambda x: x["start"] < stop))
        return _let(inside, lambda here: F.when(F.size(here) > 0, cut(here)).otherwise(block))

    whole = F.array_join(F.transform(blocks, masked), "")
    return found.withColumn(text_col, F.when(F.size(spans) > 0, whole).otherwise(F.col(text_col))).drop(spans, bounds, starts, merged, blocks)


def _end_before(spans: Column, i: Column, begin: Column) -> Column:
    """Where the unmasked characters before the ``i``-th of these spans begin."""
    return F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(begin)
