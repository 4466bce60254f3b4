"""Personal data: Aho-Corasick anchors, each expanded by a local parser that validates its boundaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import release, require
from corvane.session import text_batches

#: Kinds in the order of a document's span list; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "account", "login_url", "secret")
TAGS = {k: f"[{k.upper()}]" for k in KINDS}

_DIGITS = "0123456789"
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + _DIGITS)
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_DIGIT = frozenset(_DIGITS)
_PHONE = _DIGIT | frozenset(" ().-")
_BREAK = frozenset(" \t\n\v\f\r<>\"'`")

#: Words before an account number: the number must follow within a few separators.
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "konto", "Konto", "compte", "Compte", "cuenta", "Cuenta")
SSN_CUES = ("SSN", "ssn", "social security", "Social Security")

#: Names of secrets, each also capitalised and in capitals: a value follows after a sign of assignment (after `bearer` a space will do).
SECRET_CUES = ("token", "key", "secret", "passwd", "password", "pwd", "passphrase", "credential", "bearer")
#: Those whose values may be short.
SHORT_CUES = ("passwd", "password", "pwd", "passphrase")
#: Beginnings of secrets that need no name, with the least characters that follow.
SECRET_STARTS = {"AKIA": 16, "ASIA": 16, "ghp_": 30, "gho_": 30, "ghs_": 30, "glpat-": 16, "xoxb-": 20, "xoxp-": 20, "sk-": 20, "eyJ": 30}
KEY_BLOCK, KEY_END = "-----BEGIN ", " PRIVATE KEY-----"

_VALUE = _ALNUM | frozenset("+/_-.~")
_NAME = _ALNUM | frozenset("_-")


def _automaton() -> ahocorasick.Automaton:
    """Anchors and what they announce; the value's length tells where the anchor starts."""
    found = ahocorasick.Automaton()
    anchors = {"@": "at", "://": "scheme", "IBAN": "iban"}
    anchors |= {d: "digit" for d in _DIGITS} | {"+" + d: "plus" for d in _DIGITS}
    anchors |= dict.fromkeys(ACCOUNT_CUES, "account") | dict.fromkeys(SSN_CUES, "ssn")
    for cue in SECRET_CUES:
        anchors |= dict.fromkeys((cue, cue.capitalize(), cue.upper()), "secret")
    anchors |= dict.fromkeys(SECRET_STARTS, "start") | {KEY_BLOCK: "block"}
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign; `floor` is the end of the address before it."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    n, end, dots, i = len(text), at, 0, at + 1
    while True:
        label = i
        while i < n and text[i] in _LABEL:
            i += 1
        if i == label:
            break
        end = i
        if i < n and text[i] == ".":
            dots, i = dots + 1, i + 1
        else:
            dots += 1
            break
    # `dots` counts labels here; an address needs two.
    return (start, end) if dots >= 2 and "." in text[at + 1 : end] else None


def digit_chain(text: str, start: int, separators: str) -> list[tuple[int, int]]:
    """Runs of digits from `start`, joined by single separators."""
    n, runs, i = len(text), [], start
    while True:
        begin = i
        while i < n and text[i] in _DIGIT:
            i += 1
        if i == begin:
            break
        runs.append((begin, i))
        if i < n and text[i] in separators:
            i += 1
        else:
            break
    return runs


def octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and int(digits) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """From a plus sign before a digit: the longest run of phone characters that ends in a digit."""
    n, i, last = len(text), plus + 2, -1
    while i < n and text[i] in _PHONE:
        if i >= plus + 3 and text[i] in _DIGIT:
            last = i
        i += 1
    return (plus, last + 1) if last >= 0 else None


def iban_after(text: str, i: int) -> tuple[int, int] | None:
    """An international account number after its cue, spaces allowed, check digits valid."""
    n = len(text)
    while i < n and text[i] in " :#\t":
        i += 1
    start, kept, end = i, [], i
    while i < n and len(kept) < 34 and (text[i] in _ALNUM or text[i] == " " and i + 1 < n and text[i + 1] in _ALNUM):
        if text[i] != " ":
            kept.append(text[i].upper())
            end = i + 1
            code = "".join(kept)
        i += 1
        if len(kept) >= 15 and (i >= n or text[i] not in _ALNUM) and code[:2].isalpha() and code[2:4].isdecimal():
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return start, end
    return None


def number_after(text: str, i: int, least: int, most: int, separators: str) -> tuple[int, int] | None:
    """A digit chain after a cue and at most a few separators, of `least` to `most` digits."""
    n, stop = len(text), i + 12
    while i < n and i < stop and text[i] in " :#.=numberNUMBERoO\t":
        i += 1
    runs = digit_chain(text, i, separators)
    digits = sum(b - a for a, b in runs)
    if not least <= digits <= most or runs[-1][1] < n and text[runs[-1][1]] in _ALNUM:
        return None
    return runs[0][0], runs[-1][1]


def login_url_at(text: str, colon: int) -> tuple[int, int] | None:
    """A URL whose authority carries user:password, from its scheme to the next break."""
    n, start = len(text), colon
    while start > 0 and text[start - 1] in _ALNUM:
        start -= 1
    i = colon + 3
    while i < n and text[i] not in _BREAK and text[i] not in "/?#":
        i += 1
    user, at, host = text[colon + 3 : i].rpartition("@")
    if start == colon or not at or not host or ":" not in user:
        return None
    while i < n and text[i] not in _BREAK:
        i += 1
    return start, i


def secret_after(text: str, cue: str, i: int) -> tuple[int, int] | None:
    """The value given to a name that ends in `cue` and at most 16 more name characters, from `i` on, in quotes or bare.

    A value holds no white space and at least one digit, and has 12 characters or more (a password 6; in quotes it
    needs no digit). Bare values are letters, digits and +/_-.~ with closing equals signs.
    """
    n, stop, cue = len(text), i + 16, cue.lower()
    while i < n and i < stop and text[i] in _NAME:
        i += 1
    if i < n and text[i] in "\"'":
        i += 1
    at = i
    while i < n and i < at + 4 and text[i] in " \t":
        i += 1
    if i < n and text[i] in "=:":
        i += 1
        while i < n and text[i] in "=:>" and i < at + 8:
            i += 1
    elif cue != "bearer" or i == at:
        return None
    at = i
    while i < n and i < at + 4 and text[i] in " \t":
        i += 1
    if cue != "bearer" and text[i : i + 7].lower() == "bearer ":
        i += 7
    quote = text[i : i + 1] if text[i : i + 1] in ("\"", "'", "`") else ""
    start = end = i + len(quote)
    while end < n and (text[end] != quote and text[end] not in _BREAK if quote else text[end] in _VALUE):
        end += 1
    if quote and text[end : end + 1] != quote:
        return None
    if not quote:
        while end < n and text[end] == "=":
            end += 1
        while end > start and text[end - 1] in ".~-":  # a sentence's end, not the value's
            end -= 1
    short = cue in SHORT_CUES
    digit = any(c in _DIGIT for c in text[start:end])
    return (start, end) if end - start >= (6 if short else 12) and (digit or short and quote) else None


def secret_from(text: str, start: int, i: int, least: int) -> tuple[int, int] | None:
    """A secret that its beginning (from `start` to `i`) tells, if that begins a word and at least `least` characters with a digit follow."""
    n, end = len(text), i
    while end < n and text[end] in _VALUE:
        end += 1
    while end > i and text[end - 1] in ".~-":
        end -= 1
    begins = start == 0 or text[start - 1] not in _NAME
    return (start, end) if begins and end - i >= least and any(c in _DIGIT for c in text[i:end]) else None


def key_block(text: str, start: int) -> tuple[int, int] | None:
    """A private key with its frame; one that isn't closed ends with its base64 lines."""
    head = text.find(KEY_END, start, start + 40)
    if head < 0:
        return None
    n, i = len(text), head + len(KEY_END)
    while i < n and (text[i] in _ALNUM or text[i] in "+/= \r\n\t\\"):
        i += 1
    if text.startswith("-----END ", i) and (close := text.find(KEY_END, i, i + 40)) >= 0:
        i = close + len(KEY_END)
    return start, i


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) in span-list order; the base kinds are leftmost and do not overlap within a kind."""
    spans: list[tuple[int, int, int]] = []
    email_floor = url_end = card_end = ip_end = phone_end = secret_end = 0
    for last, (kind, length) in _ANCHORS.iter(text):
        if kind == "digit":
            # The first digit of a chain announces it; the digits that follow are inside.
            if last >= card_end:
                runs = digit_chain(text, last, " -")
                card_end = runs[-1][1]
                digits = "".join(text[a:b] for a, b in runs)
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, runs[0][0], card_end))
            if last >= ip_end:
                runs = digit_chain(text, last, ".")
                ip_end = runs[-1][1]
                for k in range(0, len(runs) - 3, 4):
                    if all(octet(text[a:b]) for a, b in runs[k : k + 4]):
                        spans.append((1, runs[k][0], runs[k + 3][1]))
        elif kind == "at":
            if found := email_at(text, last, email_floor):
                email_floor = found[1]
                spans.append((0, *found))
        elif kind == "plus":
            if last - 1 >= phone_end and (found := phone_at(text, last - 1)):
                phone_end = found[1]
                if 8 <= sum(c in _DIGIT for c in text[found[0] : found[1]]) <= 15:
                    spans.append((3, *found))
        elif kind == "iban":
            if found := iban_after(text, last + 1):
                spans.append((4, *found))
        elif kind == "ssn":
            found = number_after(text, last + 1, 9, 9, "- ")
            if found:
                spans.append((5, *found))
        elif kind == "account":
            if found := number_after(text, last + 1, 6, 17, "-"):
                spans.append((6, *found))
        elif kind == "secret":
            if last >= secret_end and (found := secret_after(text, text[last + 1 - length : last + 1], last + 1)):
                secret_end = found[1]
                spans.append((8, *found))
        elif kind == "start":
            start = last + 1 - length
            if start >= secret_end and (found := secret_from(text, start, last + 1, SECRET_STARTS[text[start : last + 1]])):
                secret_end = found[1]
                spans.append((8, *found))
        elif kind == "block":
            if last >= secret_end and (found := key_block(text, last + 1 - length)):
                secret_end = found[1]
                spans.append((8, *found))
        elif last >= url_end and (found := login_url_at(text, last - 2)):
            url_end = found[1]
            spans.append((7, *found))
    return sorted(set(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each maximal cover of overlapping spans replaced by the tag of its first span."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], TAGS[KINDS[kind]]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            spans = find_spans(text.as_py() or "")
            rows.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        kept = [batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, kind)], names=[*batch.schema.names, "spans"])


def find(documents: DataFrame) -> DataFrame:
    """doc_id, text and `spans`, an array of (kind, start, end) in code points, end exclusive.

    Whole texts. Null or empty text, or one without personal data: an empty array. Repeated rows keep their
    own spans, null doc_id passes through, extra columns are left aside, no documents give no rows. Narrow:
    no shuffle, and a task holds one Arrow batch of texts.
    """
    docs = require(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_spans, "doc_id long, text string, spans array<struct<kind:string,start:long,end:long>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for spans in batch.column("spans").to_pylist():
            names = [(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in spans]
            for k in range(4):
                out[k].append(sum(kind == KINDS[k] for kind, _ in names))
            base = ",".join(x for kind, x in names if kind in KINDS[:4])
            out[4].append(hashlib.sha256(base.encode()).hexdigest())
            out[5].append(",".join(x for _, x in names))
        columns = [pa.array(c, pa.int64()) for c in out[:4]] + [pa.array(c, pa.string()) for c in out[4:]]
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])


def digest(documents: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, the hash of the base spans and all spans as text.

    Null and empty texts: counts 0, the hash of nothing, empty spans. Repeated rows and null doc_id: a row each. Whole texts
    of any length; extra columns are left aside; no documents give no rows. Equal spans of a kind are given once.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return find(documents).select("doc_id", "spans").mapInArrow(_digest, schema)


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [None if (t := x.as_py()) is None else redact(t, find_spans(t)) for x in batch.column(at)]
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def scrub(documents: DataFrame) -> DataFrame:
    """documents with every span replaced by its kind's tag; n_chars, where present, follows the new text.

    Null and empty texts stay, as do all other columns, whatever their names; each row is scrubbed by itself, repeated ones and those
    without doc_id too. Overlapping spans give one tag, that of the first, of equal starts the longest. No documents: no rows.
    """
    text_batches(documents.sparkSession)
    out = documents.mapInArrow(_redacted, documents.schema)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(documents.schema["n_chars"].dataType))
    return out
