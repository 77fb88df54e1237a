r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and account cues. Small deterministic parsers expand from an anchor to the boundaries of an email, an address, a card,
a phone number or an account, and validate it. Parsers go from left to right and never back behind the end of the
last candidate of their kind, valid or not, so they find exactly the leftmost non-overlapping matches.
"""

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import slices

# Fixed values of the contract: kinds in listed order, then the ones that the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
URL_ENDS = frozenset(" \t\n\x0b\x0c\r<>\"'`{}|\\^")
CUES = ("iban", "account number", "account no", "acct no", "kontonummer", "número de cuenta", "numéro de compte")

_automaton = None


def automaton():
    """Anchors with their parser. Built once in each Python worker."""
    global _automaton
    if _automaton is None:
        built = ahocorasick.Automaton()
        for d in "0123456789":
            built.add_word(d, ("digit", 1))
        built.add_word("@", ("at", 1))
        built.add_word("+", ("plus", 1))
        for s in SCHEMES:
            for form in (s, s.upper(), s.capitalize()):
                built.add_word(form, ("scheme", len(s)))
        for c in CUES:
            for form in (c, c.upper(), c.capitalize(), c.title()):
                built.add_word(form, ("cue", len(c)))
        built.make_automaton()
        _automaton = built
    return _automaton


def run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that starts at `at`."""
    size = len(text)
    while at < size and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, floor: int):
    """(start, end) around the at-sign at `at`, not before `floor`."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
        end = run(text, end + 1, LABEL)
        dots += 1
    return (start, end) if dots else None


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def dotted(text: str, at: int):
    """Digit parts joined by single dots, as (start, end) pairs, from the digit at `at`."""
    parts, end = [], at
    while True:
        stop = run(text, end, DIGITS)
        parts.append((end, stop))
        if not (stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in DIGITS):
            return parts
        end = stop + 1


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def grouped(text: str, at: int) -> int:
    """End of digits that single spaces or hyphens may part."""
    end = run(text, at, DIGITS)
    while end + 1 < len(text) and text[end] in " -" and text[end + 1] in DIGITS:
        end = run(text, end + 1, DIGITS)
    return end


def phone(text: str, at: int):
    """(start, end) of a number behind the plus sign at `at`: the run goes back to its last digit."""
    if not (at + 1 < len(text) and text[at + 1] in DIGITS):
        return None
    end = run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (at, end) if end > at + 3 else None


def iban(value: str) -> bool:
    if not (15 <= len(value) <= 34 and value[:2].isalpha() and value[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def account(text: str, at: int):
    """An account behind a cue that ends at `at`: an IBAN that passes mod 97, or 8 to 17 digits."""
    while at < len(text) and text[at] in " :=#.\t" :
        at += 1
    if at + 1 < len(text) and text[at] in ALNUM and text[at] not in DIGITS:
        end, value, best = at, "", None
        while end < len(text) and len(value) < 34 and (text[end] in ALNUM or text[end] == " "):
            value += text[end].upper().strip()
            end += 1
            if (end == len(text) or text[end] not in ALNUM) and text[end - 1] != " " and iban(value):
                best = (at, end)
        return best
    end = grouped(text, at)
    digits = sum(c in DIGITS for c in text[at:end])
    return (at, end) if 8 <= digits <= 17 and not (end < len(text) and text[end] in ALNUM) else None


def find(text: str) -> list[list[tuple[int, int]]]:
    """Spans of every kind of KINDS, in code points, each list ordered by its start."""
    out = [[] for _ in KINDS]
    emails, ips, cards, phones, urls, accounts = out
    email_floor = ip_floor = card_floor = phone_floor = url_floor = 0
    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= ip_floor:
                parts = dotted(text, at)
                ip_floor = parts[-1][1]
                for i in range(0, len(parts) - 3, 4):
                    if all(at_most_255(text[a:b]) for a, b in parts[i:i + 4]):
                        ips.append((parts[i][0], parts[i + 3][1]))
            if at >= card_floor:
                card_floor = grouped(text, at)
                if card_floor - at >= 13:
                    digits = "".join(c for c in text[at:card_floor] if c in DIGITS)
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        cards.append((at, card_floor))
        elif kind == "at":
            if at >= email_floor and (found := email(text, at, email_floor)):
                emails.append(found)
                email_floor = found[1]
        elif kind == "plus":
            if at >= phone_floor and (found := phone(text, at)):
                phone_floor = found[1]
                if 9 <= sum(c in DIGITS for c in text[at:found[1]]) <= 15:
                    phones.append(found)
        elif kind == "scheme":
            if at >= url_floor:
                end = last + 1
                while end < len(text) and text[end] not in URL_ENDS:
                    end += 1
                url_floor = end
                authority = text[last + 1:end].split("/")[0].split("?")[0].split("#")[0]
                user, sign, host = authority.rpartition("@")
                if sign and user and host:  # names or passwords inside an address
                    urls.append((at, end))
        elif found := account(text, last + 1):
            if not accounts or found[0] >= accounts[-1][1]:
                accounts.append(found)
    return out


def listed(found, kinds) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k in kinds for a, b in found[k])


def _scan(batches):
    for part in slices(batches, "text"):
        ids, texts = part.column("doc_id"), part.column("text").to_pylist()
        found = [find(t or "") for t in texts]
        columns = [pa.array([len(f[k]) for f in found], pa.int64()) for k in range(len(BASE))]
        columns.append(pa.array([hashlib.sha256(listed(f, range(len(BASE))).encode()).hexdigest() for f in found]))
        columns.append(pa.array([listed(f, range(len(KINDS))) for f in found], pa.string()))
        yield pa.RecordBatch.from_arrays([ids, *columns], names=[
            "doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])


def scan_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Null and empty texts have no span; texts of any length are read whole, in one pass that is linear in the length.
    Null ids and repeated rows each keep their row; other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                  "base_sha256 string, spans string")


def redact(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; of spans that overlap, the earliest
    stays and grows to the end of the last."""
    spans = sorted((a, b, k) for k, found in enumerate(find(text)) for a, b in found)
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = end
        i += 1
    return "".join(out) + text[at:] if out else text


def redact_documents(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows with personal data in `column` replaced; nulls stay null and every other column stays as it is."""
    place = docs.columns.index(column)

    def run(batches):
        for part in slices(batches, column):
            texts = [None if t is None else redact(t) for t in part.column(column).to_pylist()]
            columns = [*part.columns]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)
