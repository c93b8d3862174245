"""Personal data by rule: patterns propose spans, checks confirm them, nearby words adjust the confidence.

Only SQL functions run. Positions come from splitting a text at the matches: piece and match lengths add up to code
point offsets. Two single characters are marked before matching, so that every repetition in a pattern is of one
character class: a dot between two domain characters, and a separator between two digits. Matching is then linear and
needs no stack, however long a run of digits or labels is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban")
MARK = "\x01"
CONTEXT_CHARS = 40
NEIGHBOURS = 10  # no match is shorter than four characters, so ten of them fill the context
BLOCK = 128
REDACTION_BLOCK = 512
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Kind:
    """``hint``: what a text must have for the pattern to be tried. ``words``, as whole words, raise the confidence from ``base``."""

    pattern: str
    hint: str
    words: str
    base: int


def _words(*names: str) -> str:
    return f"(?:^|[^a-z])(?:{'|'.join(names)})(?:[^a-z]|$)"


# The patterns of the base kinds, written for the marked text.
RULES = {
    "email": Kind(rf"(?:\G|(?<![A-Za-z0-9._%+{MARK}-]))[A-Za-z0-9._%+{MARK}-]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]++", "@", _words("e-?mails?", "mailto", "mail", "contacts?", "write", "address(?:es)?"), 80),
    "ip": Kind(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", _words("ip", "hosts?", "servers?", "address(?:es)?", "logins?"), 60),
    "card": Kind(rf"[0-9][0-9{MARK}]{{12,}}+", "[0-9][ 0-9-]{12}", _words("cards?", "visa", "mastercard", "master", "credit", "payments?", "expir(?:y|es|ed|ation)"), 70),
    "phone": Kind(r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", _words("(?:tele)?phones?", "tel", "call(?:s|ed|ing)?", "fax", "mobile", "cell"), 60),
    "iban": Kind(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "[A-Z]{2}[0-9]{2}", _words("iban", "accounts?", "bank", "transfers?"), 80),
}


def _bound(value: Column, body) -> Column:
    """``body`` of a variable that holds ``value``, so that ``value`` is worked out once, not once for each element of an inner array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(rows: Column, size: int) -> Column:
    """An array cut into arrays of ``size``. Growing an array copies it, so long ones are built block by block."""
    return F.when(F.size(rows) == 0, F.array()).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / size).cast("int")), lambda b: F.slice(rows, b * size + 1, F.lit(size)))
    )


def _placed(matches: Column) -> Column:
    """Matches as (i, found, gap before it) get their ``start``: running sums inside blocks, then from block to block."""
    inner, outer = "array<struct<i:int,start:int,found:string>>", "array<array<struct<i:int,start:int,found:string>>>"

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        row = F.struct(x["i"].alias("i"), start.alias("start"), x["found"].alias("found"))
        return F.struct((start + F.length(x["found"])).alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    def block(acc: Column, rows: Column) -> Column:
        done = F.aggregate(rows, F.struct(acc["at"].alias("at"), F.array().cast(inner).alias("out")), one)
        return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(outer).alias("out"))
    return _bound(matches, lambda m: F.aggregate(_blocks(m, BLOCK), empty, block, lambda acc: F.flatten(acc["out"])))


def _ends(text: Column) -> Column:
    """A text without its middle: both contexts it can take part in stay."""
    return F.when(F.length(text) > 2 * CONTEXT_CHARS, F.concat(F.left(text, F.lit(CONTEXT_CHARS)), F.right(text, F.lit(CONTEXT_CHARS)))).otherwise(text)


def _proposed(text: Column, rule: Kind, kind: str) -> Column:
    """Confirmed matches of the pattern as (start, found, around): starts in code points from 0, the characters on both sides.

    Every step is linear in the text but for the copies of blocks: nothing looks for a position from the start of the text.
    """

    def matched(s: Column) -> Column:
        rows = F.transform(
            s["found"], lambda f, i: F.struct(i.alias("i"), f.alias("found"), F.length(F.get(s["pieces"], i)).alias("gap"))
        )
        sides = F.transform(s["pieces"], lambda p, i: _ends(F.concat(_ends(p), F.coalesce(_ends(F.get(s["found"], i)), F.lit("")))))

        def with_context(around: Column) -> Column:
            def row(x: Column) -> Column:
                low = F.greatest(x["i"] - NEIGHBOURS, F.lit(0))
                before = F.concat(F.array_join(F.slice(around, low + 1, x["i"] - low), ""), _ends(F.get(s["pieces"], x["i"])))
                after = F.array_join(F.slice(around, x["i"] + 2, F.lit(NEIGHBOURS)), "")
                sides = F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(after, F.lit(CONTEXT_CHARS)))
                return F.struct(x["start"].alias("start"), x["found"].alias("found"), sides.alias("around"))

            return F.transform(F.filter(_placed(rows), lambda x: _confirmed(kind, x["found"])), row)

        return _bound(sides, with_context)

    split = F.struct(F.split(text, rule.pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"))
    empty = F.array().cast("array<struct<start:int,found:string,around:string>>")
    return F.when(text.rlike(rule.hint), _bound(split, matched)).otherwise(empty)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Checksum of payment card numbers."""
    n = F.length(digits)

    def weight(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + weight(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """Checksum of account numbers: country and check digits moved to the end, letters read as 10 to 35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, acc * 10 + value).otherwise(acc * 100 + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


def _confirmed(kind: str, found: Column) -> Column:
    digits = _digits(found)
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(found)
    return F.lit(True)


def pii_spans(text: Column) -> Column:
    """All confirmed spans as array<struct<kind, start, end, confidence>>, by kind in the order of ``KINDS``, then start.

    ``confidence`` is a percentage: the kind's base, raised when one of its words stands within 40 characters. It never
    removes a span. A null text has no spans.
    """
    text = F.coalesce(text, F.lit(""))
    marked = {
        "email": F.regexp_replace(F.translate(text, MARK, "\x02"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK),
        "card": F.regexp_replace(F.translate(text, MARK, "\x02"), "(?<=[0-9])[ -](?=[0-9])", MARK),
    }

    def spans(kind: str) -> Column:
        rule = RULES[kind]
        source = text
        if kind in marked:
            source = F.when(text.rlike(rule.hint), marked[kind]).otherwise(F.lit(""))
            rule = Kind(rule.pattern, rf"[{MARK}0-9@]", rule.words, rule.base)

        def described(x: Column) -> Column:
            near = F.lower(x["around"]).rlike(rule.words)
            return F.struct(
                F.lit(kind).alias("kind"),
                x["start"].alias("start"),
                (x["start"] + F.length(x["found"])).alias("end"),
                F.when(near, F.lit(rule.base + 15)).otherwise(F.lit(rule.base)).alias("confidence"),
            )

        return F.transform(_proposed(source, rule, kind), described)

    return F.concat(*[spans(k) for k in KINDS])


def find_pii(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the spans of their text in column ``into`` (replaced if there is one)."""
    return docs.withColumn(into, pii_spans(F.col(text_col)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones as one, replaced by the kind of its first: ``[EMAIL]``.

    Null and span-free texts come back as they are.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    texts = "array<string>"

    def block(acc: Column, rows: Column) -> Column:
        to = F.greatest(acc["at"], F.array_max(F.transform(rows, lambda s: s["end"])))
        own = F.struct(to.alias("to"), F.substring(text, acc["at"] + 1, to - acc["at"]).alias("text"))

        def one(own: Column, done: Column, s: Column) -> Column:
            part = F.substring(own["text"], done["at"] - acc["at"] + 1, s["start"] - done["at"])
            parts = F.concat(done["parts"], F.array(part, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
            return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] >= done["at"], parts).otherwise(done["parts"]).alias("parts"))

        def replaced(own: Column) -> Column:
            start = F.struct(acc["at"].alias("at"), F.array().cast(texts).alias("parts"))
            out = F.aggregate(rows, start, lambda done, s: one(own, done, s), lambda done: F.array_join(done["parts"], ""))
            return F.struct(own["to"].alias("at"), F.concat(acc["out"], F.array(out)).alias("out"))

        return _bound(own, replaced)

    done = _bound(
        ordered,
        lambda rows: F.aggregate(
            _blocks(rows, REDACTION_BLOCK),
            F.struct(F.lit(0).alias("at"), F.array().cast(texts).alias("out")),
            block,
            lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
        ),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; every row and column stays, repeated rows too."""
    taken, own = {c.lower() for c in docs.columns}, "__pii"
    while own in taken:
        own += "_"
    with_spans = docs.select("*", pii_spans(F.col(text_col)).alias(own))
    return with_spans.withColumn(text_col, redacted(F.col(text_col), F.col(own))).drop(own)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
