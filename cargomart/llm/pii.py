"""Personal data: regular expressions propose spans, checksums confirm them,
and context words on either side of a span adjust its score.

DataFrame functions only, one pass over the texts and no shuffle.  The
expressions give a text's parts between matches (split) and the matches; the
running sum of their lengths is where each match stands.  Possessive
quantifiers and look-behinds keep every expression linear in the text, however
long a run of letters or digits is, and give the same matches as the plain
forms in the comments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, and what a match of each must be.
KINDS = ("email", "ip", "card", "phone")
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_VALID = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
#: [0-9]([\x20-]?[0-9])+ of 14 to 19 digits: the whole run, or nothing.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
#: \+[0-9][\x20().0-9-]+[0-9]
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: What the method proposes beyond the base: a card or a telephone number
#: within a longer run of digits, bank accounts (mod 97) and social security
#: numbers (only with a context word).
CARD_WITHIN = r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{14,19})(?![0-9])"
PHONE_WITHIN = r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"

#: Characters on either side of a span, up to the next match of its rule, in
#: which context words count, and what they add.
CONTEXT_CHARS = 48
CONTEXT_SCORE = 0.25
#: What stands between the members of a list: no word at all, or a separator
#: within CONTEXT_CHARS, or one line break between rows of cells.
BARE = r"^[^\p{L}\p{N}]*+$"
SEPARATOR = r"(?i)[,;/|&\t\r\n]|\b(?:and|or|und|oder|et|ou|y|o)\b"
ROWS = r"^(?:[^\n|;,\t]*+[|;,\t][^\n]*+\n[^\n]*+|[^\n]*+\n[^\n|;,\t]*+[|;,\t][^\n]*+)$"
#: Added spans below this score are dropped; base spans stay.
MIN_SCORE = 0.5


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    score: float
    context: str
    needs: str  # a cheap test of the whole text
    base: bool


RULES = (
    Rule("email", EMAIL, 0.9, r"(?i)\b(?:e-?mail|contact|write|mailto|courriel|correo)\b", "@", True),
    Rule("ip", IP, 0.6, r"(?i)\b(?:ip|host|server|address|adresse|login)\b", ".", True),
    Rule("card", CARD, 0.7, r"(?i)\b(?:card|visa|credit|debit|mastercard|karte|carte|tarjeta)\b", "", True),
    Rule("phone", PHONE, 0.6, r"(?i)\b(?:tel|phone|call|mobile|fax|telefon)\b", "+", True),
    Rule("card", CARD_WITHIN, 0.6, r"(?i)\b(?:card|visa|credit|debit|mastercard|karte|carte|tarjeta)\b", "", False),
    Rule("phone", PHONE_WITHIN, 0.55, r"(?i)\b(?:tel|phone|call|mobile|fax|telefon)\b", "+", False),
    Rule("iban", IBAN, 0.8, r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b", "", False),
    Rule("ssn", SSN, 0.3, r"(?i)\b(?:ssn|social|security|insurance)\b", "-", False),
)


def luhn(match: Column) -> Column:
    """14 to 19 digits whose Luhn sum ends in 0."""
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * (2 - i % 2)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.length(digits).between(14, 19) & (total % 10 == 0)


def mod97(match: Column) -> Column:
    """A bank account number whose check digits are right (ISO 7064)."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), acc * 10 + c.cast("int")).otherwise(acc * 100 + letter) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _valid(rule: Rule, match: Column) -> Column:
    if rule.kind == "ip":
        return match.rlike(IP_VALID)
    if rule.kind == "card":
        return luhn(match)
    if rule.kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(10, 15)
    if rule.kind == "iban":
        return mod97(match)
    return F.lit(True)


def _needed(rule: Rule, text: Column) -> Column:
    return F.contains(text, F.lit(rule.needs)) if rule.needs else text.rlike("[0-9]")


def _linked(part: Column) -> Column:
    """Whether the matches before and after ``part`` stand in one list."""
    near = (F.length(part) <= CONTEXT_CHARS) & part.rlike(SEPARATOR)
    return part.rlike(BARE) | near | part.rlike(ROWS)


#: Elements that a scan goes through before it hands them on, and code points
#: of the pieces that a text is cut from.
BLOCK, PIECE = 128, 4096
_SPAN = "struct<start:int,order:int,end:int,kind:string,score:double,base:boolean>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(items: Column, first: Column, step, kind: str) -> Column:
    """The states of a left-to-right pass: ``step(state, item)`` for each item,
    of SQL type ``kind``.  An array that grows by one is copied each time, so the
    pass goes block by block and its cost stays in proportion to the items."""
    none = F.lit([]).cast(f"array<{kind}>")
    last = lambda out, state: F.when(F.size(out) > 0, F.element_at(out, -1)).otherwise(state)

    def through(state: Column, block: Column) -> Column:
        return F.aggregate(block, none, lambda out, x: F.concat(out, F.array(_let(last(out, state), lambda s: step(s, x)))))

    def add(acc: Column, block: Column) -> Column:
        state = F.when(F.size(acc) > 0, F.element_at(F.element_at(acc, -1), -1)).otherwise(first)
        return _let(state, lambda s: F.concat(acc, F.array(through(s, block))))

    def whole(items: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
        blocks = F.transform(starts, lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(items) > 0, F.flatten(F.aggregate(blocks, F.lit([]).cast(f"array<array<{kind}>>"), add))).otherwise(none)

    return _let(items, whole)


def _proposed(rule: Rule, nth: int, text: Column) -> Column:
    """Spans of a rule's valid matches, in order: start and end (code points,
    end exclusive), order and name of the kind, score.  A context word next to
    one member of a list counts for all of them."""
    # Texts without a match, which are the most by far, are one part.
    spans = _let(F.split(text, rule.pattern, -1), lambda parts: F.when(F.size(parts) > 1, _placed(rule, nth, text, parts)))
    return F.coalesce(F.when(_needed(rule, text), spans), F.lit([]).cast(f"array<{_SPAN}>"))


def _placed(rule: Rule, nth: int, text: Column, parts: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    # The part after the last match has none.
    pairs = F.zip_with(parts, found, lambda p, m: F.struct(
        F.length(p).alias("gap"), m.alias("match"), (m.isNotNull() & _valid(rule, m)).alias("valid"), _linked(p).alias("linked"),
        F.right(p, F.lit(CONTEXT_CHARS)).rlike(rule.context).alias("before"), F.left(p, F.lit(CONTEXT_CHARS)).rlike(rule.context).alias("after"),
    ))
    kind = "struct<start:int,end:int,valid:boolean,goes_on:boolean,closes:boolean,named:boolean>"

    def place(s: Column, x: Column) -> Column:
        """Where a match stands, whether it goes on the list before it, whether
        that list has a context word (its last one right after it), and whether
        the match's own list has one so far."""
        start = s["end"] + x["gap"]
        closes = s["named"] | ((s["end"] > 0) & x["after"])
        goes_on = x["match"].isNotNull() & x["linked"]
        return F.struct(
            start.alias("start"), (start + F.coalesce(F.length(x["match"]), F.lit(0))).alias("end"), x["valid"].alias("valid"),
            goes_on.alias("goes_on"), closes.alias("closes"), ((goes_on & closes) | x["before"]).alias("named"),
        )

    no = F.lit(False)
    begin = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), no.alias("valid"), no.alias("goes_on"), no.alias("closes"), no.alias("named"))
    placed = _scan(pairs, begin, place, kind)

    def ended(s: Column, x: Column) -> Column:
        """From the end: what a list's last member's successor says of the list."""
        named = s["next"]
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["valid"].alias("valid"), named.alias("named"),
            F.when(x["goes_on"], named).otherwise(x["closes"]).alias("next"),
        )

    over = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), no.alias("valid"), no.alias("named"), no.alias("next"))
    listed = _scan(F.reverse(placed), over, ended, "struct<start:int,end:int,valid:boolean,named:boolean,next:boolean>")
    score = lambda x: F.least(F.lit(rule.score) + F.when(x["named"], F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0)), F.lit(1.0))
    kept = F.filter(F.reverse(listed), lambda x: x["valid"] & (F.lit(rule.base) | (score(x) >= MIN_SCORE)))
    return F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.lit(nth).alias("order"), x["end"].alias("end"), F.lit(rule.kind).alias("kind"),
        score(x).alias("score"), F.lit(rule.base).alias("base"),
    ))


def _without_clashes(base: Column, more: Column) -> Column:
    """Added spans that no base span of their kind overlaps.  Base spans of a
    kind don't overlap, so the nearest on either side is the one to ask."""
    return F.when(F.size(more) > 0, _clear(base, more)).otherwise(more)


def _clear(base: Column, more: Column) -> Column:
    order = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x.alias("x"))
    both = F.transform(F.array_sort(F.transform(F.concat(base, more), order)), lambda y: y["x"])
    kind = f"struct<x:{_SPAN},kind:string,edge:int,free:boolean>"

    def ask(before: bool):
        def step(s: Column, y: Column) -> Column:
            x, so_far = (y["x"], y["free"]) if not before else (y, F.lit(True))
            clear = (s["edge"] <= x["start"]) if before else (s["edge"] >= x["end"])
            free = so_far & (x["base"] | s["edge"].isNull() | (s["kind"] != x["kind"]) | clear)
            edge = x["end"] if before else x["start"]
            same = F.when(s["kind"] == x["kind"], s["edge"])
            return F.struct(x.alias("x"), x["kind"].alias("kind"), F.when(x["base"], edge).otherwise(same).alias("edge"), free.alias("free"))

        return step

    nothing = F.lit(None).cast(kind)
    forth = _scan(both, nothing, ask(True), kind)
    back = _scan(F.reverse(forth), nothing, ask(False), kind)
    return F.transform(F.filter(back, lambda y: y["free"] & ~y["x"]["base"]), lambda y: y["x"])


def _with_spans(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with all spans as a column ``name``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = docs
    for k, rule in enumerate(RULES):
        raw = raw.withColumn(f"_spans{k}", _proposed(rule, KINDS.index(rule.kind) if rule.kind in KINDS else k, text))
    base = F.concat(*[F.col(f"_spans{k}") for k, r in enumerate(RULES) if r.base])
    more = F.concat(*[F.col(f"_spans{k}") for k, r in enumerate(RULES) if not r.base])
    return raw.withColumn(name, F.array_sort(F.concat(base, _without_clashes(base, more)))).drop(
        *[f"_spans{k}" for k in range(len(RULES))]
    )


def find(docs: DataFrame) -> DataFrame:
    """Adds ``spans`` to rows with a ``text`` (null: empty): all spans by start
    and kind.  A span that the method adds is dropped if one of the same kind
    from the base overlaps it.  Rows with no text have an empty array; there is
    no limit on a text's spans."""
    return _with_spans(docs, "spans")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans by kind, and the spans as text."""
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda x: x["base"])
    of = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of(k) for k in KINDS], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans")
    )


def _regions(spans: Column) -> Column:
    """Spans in order, those that overlap merged into one.  Its kind is that of
    the first base span in it, or else of its longest."""
    kind = "struct<start:int,end:int,kind:string,base:boolean,size:int>"

    def step(last: Column, x: Column) -> Column:
        size = x["end"] - x["start"]
        joins = F.coalesce(x["start"] < last["end"], F.lit(False))
        wins = ~joins | (~last["base"] & (x["base"] | (size > last["size"])))
        kept = lambda f, value: F.when(wins, value).otherwise(last[f]).alias(f)
        return F.struct(
            F.when(joins, last["start"]).otherwise(x["start"]).alias("start"),
            F.when(joins, F.greatest(last["end"], x["end"])).otherwise(x["end"]).alias("end"),
            kept("kind", x["kind"]), kept("base", x["base"]), kept("size", size),
        )

    grown = _scan(spans, F.lit(None).cast(kind), step, kind)
    # A region is what it has grown to when the next one starts elsewhere.
    return _let(grown, lambda g: F.filter(g, lambda x, i: F.coalesce(F.get(g, i + 1)["start"] != x["start"], F.lit(True))))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """A part of the text that was cut into ``pieces`` of PIECE code points."""
    a, b = (F.floor(x / PIECE).cast("int") for x in (start, end))
    whole = F.array_join(F.slice(pieces, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
    head, tail = (F.coalesce(F.get(pieces, x), F.lit("")) for x in (a, b))
    within = F.substring(head, start % PIECE + 1, end - start)
    across = F.concat(F.substring(head, start % PIECE + 1, F.lit(PIECE)), whole, F.substring(tail, F.lit(1), end % PIECE))
    return F.when(a == b, within).otherwise(across)


def redact(docs: DataFrame) -> DataFrame:
    """Texts with each span that ``find`` has replaced by its kind in angle
    brackets (overlapping spans by one), and ``n_chars`` of the new text where
    that column exists.  Null texts stay null."""
    names, text, regions = docs.columns, F.col("text"), F.col("_regions")
    docs = _with_spans(docs, "_found").withColumn("_regions", _regions(F.col("_found")))

    # A substring is found from its text's start, so long texts are cut first.
    docs = docs.withColumn("_pieces", F.when(F.size(regions) > 0, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    pieces = F.col("_pieces")

    def put(x: Column, i: Column) -> Column:
        at = F.when(i > 0, F.get(regions, i - 1)["end"]).otherwise(F.lit(0))
        return F.concat(_cut(pieces, at, x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))

    tail = _cut(pieces, F.element_at(regions, -1)["end"], F.length(text))
    new = F.concat(F.array_join(F.transform(regions, put), ""), tail)
    docs = docs.withColumn("text", F.when(text.isNotNull() & (F.size(regions) > 0), new).otherwise(text))
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(dict(docs.dtypes)["n_chars"]))
    return docs.select(*[f"`{c}`" for c in names])
