"""Personal data: fixed base patterns, and a semi-Markov conditional random field.

The base kinds (email, ip, card, phone) follow fixed rules and always stay. The field scores
whole candidate segments of up to ``MAX_TOKENS`` tokens with features of the span as one
string (the shape of its groups, digits, checksums, cue words before it), and a score for a
kind that directly follows another; dynamic programming over (token, last kind) picks
boundaries and kinds jointly. Everything outside the entities scores zero. What it finds beyond
the base spans (obfuscated addresses, national phone formats, secrets, social security and
bank account numbers) is added where it overlaps none of them.

Which tokens can stand side by side in one segment is a rule of two tokens (``_bonds``): no
line break, comma or other foreign sign, no two plain words. It cuts a text into runs that no
candidate crosses, so the optimum of the text is the union of those of its runs, and only
runs with a digit, an ``@`` or a spelt-out dot are scored. Weights are fitted on the driver by
gradient ascent on sentences generated from fixed templates with a fixed seed, and are a
vector of fixed size.

Defined results: a null or empty text holds nothing; repeated rows are searched alike; a
null doc_id stays null; very long texts are searched whole; of labellings with equal scores
the one that labels less wins, then the one whose segment is listed first, then the kind
listed first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import doc_texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "secret", "ssn")
#: room for an address spelt out with two local parts and five labels, each bracket a token
MAX_TOKENS = 23
WEIGHTS = 1 << 14
#: digits of the longest number of several groups (a bank account's)
MOST_DIGITS = 34
#: digits of the longest that has no letters (a card's)
MOST_BARE = 19
#: digits of the shortest number of one kind that has no letters and no dots
LEAST_DIGITS = 7
#: characters of the shortest secret
LEAST_SECRET = 12

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return (sum(map(int, digits[-1::-2])) + sum(twice[int(d)] for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the fixed rules, in code points, each kind leftmost and
    non-overlapping; every search is linear in the text."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_TRIGGER = re.compile(r"[0-9]|@|\bdot\b|\[\.\]|\(\.\)", re.I)
#: signs that may stand inside an entity
INNER = frozenset(".-_@+()[]%")
MARKS = ("at", "dot")
#: fixed values: words that announce a kind
CUES = {"password", "passwd", "pwd", "secret", "token", "key", "apikey", "auth", "phone", "tel", "call", "mobile", "fax", "ssn", "social",
        "iban", "account", "card", "visa", "mail", "email", "contact", "ip", "host", "server"}


_CLASSES = str.maketrans({**dict.fromkeys("0123456789", "9"), **dict.fromkeys("abcdef", "f"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "x"),
                          **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "X")})
_HEX = re.compile(r"[0-9a-f]{8,}\Z")
_ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}")


class Token(NamedTuple):
    """What one token tells about the segments it can be part of."""

    alnum: bool
    word: bool  # letters only, neither a mark nor a short group of capitals
    mark: bool
    digits: int
    letters: bool
    shape: str
    lower: str
    inner: bool


class _Memo(dict):
    """key -> make(key), remembered for up to a bounded number of keys."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) > 200_000:
            self.clear()
        self[key] = v = self.make(key)
        return v


def _token(tok: str) -> Token:
    if not tok.isalnum():
        return Token(False, False, False, 0, False, tok, tok, tok in INNER)
    digits = sum("0" <= c <= "9" for c in tok)
    lower = tok.lower()
    if digits == len(tok):
        shape = f"9{min(digits, 21)}"
    elif digits and _HEX.match(tok):
        shape = f"h{min(len(tok), 64) // 4}"
    elif lower in MARKS:
        shape = lower
    elif tok.isalpha():
        shape = "U" if tok.isupper() and len(tok) <= 4 else "X" if tok[0].isupper() else "x"
    else:
        shape = re.sub(r"(.)\1{2,}", r"\1\1+", tok[:80].translate(_CLASSES))
    return Token(True, tok.isalpha() and lower not in MARKS and not (tok.isupper() and len(tok) <= 4), lower in MARKS, digits,
                 digits < len(tok) and lower not in MARKS, shape, lower, True)


def _ids(*names: str) -> list[int]:
    return [xxhash.xxh32_intdigest(n) % WEIGHTS for n in names]


def _span_ids(key: tuple) -> list[int]:
    """The features that a span has by itself."""
    shape, n, digits, ats, marks, letters, chars, spaces, first, last, dots, dashes = key
    return _ids("bias", f"s={shape}", f"n={n}", f"d={digits}", f"a={ats}/{marks}/{letters}", f"e={first}|{last}", f"w={chars}/{spaces}",
                f"m={dots}{dashes}/{'(' in shape}/{shape[0] == '+'}")


def _place_ids(key: tuple) -> list[int]:
    """The features of a span's surroundings and checks."""
    cue, hexish, letters, glue, before, card, ip = key
    return _ids(f"c={cue}", f"c={cue}/{hexish}/{letters}", f"g={glue}", f"p={before}", f"l={card}/{ip}")


_TOKENS, _SPAN_IDS, _PLACE_IDS = _Memo(_token), _Memo(_span_ids), _Memo(_place_ids)


def _bonds(text: str, toks: list[tuple[int, int]], props: list[Token], k: int) -> bool:
    """Whether tokens k and k + 1 can be in one segment."""
    a, b = props[k], props[k + 1]
    if not (a.inner and b.inner):
        return False
    gap = text[toks[k][1]:toks[k + 1][0]]
    if not gap:
        return True
    if len(gap) > 2 or "\n" in gap or "\r" in gap:
        return False
    if a.alnum and b.alnum:
        return not (a.word or b.word) or a.mark or b.mark
    if a.shape == "@" or b.shape == "@":
        return True
    if a.word:  # a word before a bracket that spells out a sign
        return b.shape in "([" and k + 2 < len(props) and props[k + 2].mark
    if b.word:
        return a.shape in ")]" and k > 0 and props[k - 1].mark
    return True


def _runs(text: str, toks: list[tuple[int, int]], props: list[Token]) -> Iterator[tuple[int, int]]:
    """The runs of tokens that hold a trigger, as (first, last + 1)."""
    start = 0
    for k in range(len(toks)):
        if k + 1 == len(toks) or not _bonds(text, toks, props, k):
            if any(p.digits or p.shape == "@" or p.mark and p.lower == "dot" for p in props[start:k + 1]) or "[.]" in (run := text[toks[start][0]:toks[k][1]]) or "(.)" in run:
                yield start, k + 1
            start = k + 1


def _candidates(text: str, toks: list[tuple[int, int]], props: list[Token], lo: int, hi: int, first: int, stop: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """The candidate segments of a run that begin from ``first`` up to ``stop``, and their features."""
    cand, feats = [], []
    for i in range(first, stop):
        p = props[i]
        if not p.alnum and p.shape not in "(+":
            continue
        s = toks[i][0]
        digits = dots = dashes = ats = marks = spaces = 0
        letters = trigger = False
        shape, cue, edge = "", None, None
        for j in range(i, min(hi, i + MAX_TOKENS)):
            q, e = props[j], toks[j][1]
            if j > i and toks[j][0] > toks[j - 1][1]:
                spaces += 1
                shape += " "
            shape += q.shape
            digits += q.digits
            letters |= q.letters
            dots += q.shape == "."
            dashes += q.shape == "-"
            ats += q.shape == "@"
            marks += q.mark
            trigger = trigger or q.digits > 0 or q.shape == "@" or q.lower == "dot" or q.shape == "." and 0 < j < len(toks) - 1 and text[toks[j][0] - 1] in "[(" and text[e:e + 1] in ("]", ")")
            if j > i and digits > (MOST_DIGITS if letters else MOST_BARE) and (spaces or not letters):
                break
            if not q.alnum or not trigger:
                continue
            if not ats and not marks:
                if letters:
                    if not (not spaces and e - s >= LEAST_SECRET or _ACCOUNT.match(text, s, s + 4)):
                        continue
                elif digits < LEAST_DIGITS and dots != 3:
                    continue
            if cue is None:
                before = [props[k].lower for k in range(max(0, i - 4), i)]
                cue = next((w for w in reversed(before) if w in CUES), "-")
                edge = (s > 0 and (text[s - 1].isalnum() or text[s - 1] in "@.-_+/")) * 1
                prev = before[-1] if before and not before[-1].isalnum() and toks[i - 1][1] == s else "-"
            right = (e < len(text) and (text[e].isalnum() or text[e] in "@_/" or text[e] in ".-" and text[e + 1:e + 2].isalnum())) * 2
            number = ""
            if 12 <= digits <= 19 or dots == 3:
                number = "".join(c for c in text[s:e] if "0" <= c <= "9")
            ok = 12 <= digits <= 19 and luhn(number)
            ip = dots == 3 and not letters and shape.count("9") == 4 and j - i == 6 and all(int(x) < 256 for x in text[s:e].split(".") if x.isdigit())
            feats.append(_SPAN_IDS[shape, j - i + 1, min(digits, 24), ats, min(marks, 3), letters, min(e - s, 64) // 4, min(spaces, 6), p.shape, q.shape, dots, dashes]
                         + _PLACE_IDS[cue, not spaces and i == j and shape[0] == "h", letters, edge + right, prev, ok, ip])
            cand.append((i, j))
    return cand, feats


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """The lines of a text that hold a trigger."""
    at = 0
    while m := _TRIGGER.search(text, at):
        lo, hi = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
        at = len(text) if hi < 0 else hi
        yield lo, at


def _line_runs(text: str) -> Iterator[tuple[list[tuple[int, int]], list[Token], int, int]]:
    """Each run of a text, with the tokens of the line it is in."""
    for lo, hi in _lines(text):
        toks = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
        props = [_TOKENS[text[a:b]] for a, b in toks]
        for first, stop in _runs(text, toks, props):
            yield toks, props, first, stop


def segments(text: str, lo: int, hi: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], np.ndarray]:
    """Tokens of text[lo:hi], its candidate segments, and their feature ids (13 each)."""
    toks = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
    place = {s: k for k, (s, _) in enumerate(toks)}
    cand, feats = [], []
    for mine, props, first, stop in _line_runs(text):
        c, f = _candidates(text, mine, props, first, stop, first, stop)
        inside = [k for k, (i, j) in enumerate(c) if lo <= mine[i][0] and mine[j][1] <= hi]
        cand += [(place[mine[c[k][0]][0]], place[mine[c[k][1]][0]]) for k in inside]
        feats += [f[k] for k in inside]
    return toks, cand, np.array(feats, np.int64).reshape(-1, 13)


def _scores(w: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """(candidates, kinds) segment scores; w has a row for each kind."""
    return w[:, feats].sum(axis=2).T if len(feats) else np.zeros((0, len(w)))


def _follow(w: np.ndarray) -> np.ndarray:
    """(kind before, kind) scores of a segment that directly follows another."""
    return w[:, WEIGHTS:].T


def decode(n: int, cand: list[tuple[int, int]], score: np.ndarray, follow: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """The best labelling: (first token, last token, kind) of its entities."""
    kinds = score.shape[1]
    into = np.zeros((kinds + 1, kinds))  # by the label before, 0 being none
    if follow is not None:
        into[1:] = follow
    ends: dict[int, list[int]] = {}
    for k, (_, j) in enumerate(cand):
        ends.setdefault(j, []).append(k)
    best = np.full((n + 1, kinds + 1), -np.inf)
    best[0, 0] = 0
    back: list[list[tuple[int, int, int] | None]] = [[None] * (kinds + 1)]  # segment, label before
    top = [0]
    for j in range(n):
        row: list = [None] * (kinds + 1)
        last = top[j]
        best[j + 1, 0], row[0] = best[j, last], (-1, last)
        for c in ends.get(j, ()):
            i = cand[c][0]
            each = best[i][:, None] + into
            label = each.argmax(axis=0)
            value = each[label, range(kinds)] + score[c]
            for k in np.nonzero(value > best[j + 1, 1:])[0]:
                best[j + 1, k + 1], row[k + 1] = value[k], (c, int(label[k]))
        back.append(row)
        top.append(int(best[j + 1].argmax()))
    out, j, label = [], n, top[n]
    while j > 0:
        c, before = back[j][label]
        if c < 0:
            j -= 1
        else:
            out.append((*cand[c], label - 1))
            j = cand[c][0]
        label = before
    return out[::-1]


def _forward_backward(n: int, cand, score, follow) -> tuple[np.ndarray, np.ndarray]:
    """P(segment, kind), and the expected number of times each kind directly follows another."""
    kinds = score.shape[1]
    into = np.concatenate([np.zeros((1, kinds)), follow])
    fwd, bwd = np.full((n + 1, kinds + 1), -np.inf), np.full((n + 1, kinds + 1), -np.inf)
    fwd[0, 0], bwd[n] = 0, 0
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for k, (i, j) in enumerate(cand):
        starts.setdefault(i, []).append(k)
        ends.setdefault(j, []).append(k)
    entry: dict[int, np.ndarray] = {}
    for j in range(n):
        if j in starts:
            entry[j] = np.logaddexp.reduce(fwd[j][:, None] + into, axis=0)
        fwd[j + 1, 0] = np.logaddexp.reduce(fwd[j])
        for c in ends.get(j, ()):
            fwd[j + 1, 1:] = np.logaddexp(fwd[j + 1, 1:], entry[cand[c][0]] + score[c])
    for i in range(n - 1, -1, -1):
        bwd[i] = bwd[i + 1, 0]
        for c in starts.get(i, ()):
            bwd[i] = np.logaddexp(bwd[i], np.logaddexp.reduce(into + score[c] + bwd[cand[c][1] + 1, 1:], axis=1))
    whole = np.logaddexp.reduce(fwd[n])
    outer = np.array([entry[i] + bwd[j + 1, 1:] for i, j in cand]).reshape(-1, kinds)
    pairs = np.zeros((kinds, kinds))
    for c, (i, j) in enumerate(cand):
        if np.isfinite(fwd[i, 1:]).any():
            pairs += np.exp(fwd[i, 1:, None] + follow + score[c] + bwd[j + 1, 1:] - whole)
    return np.exp(score + outer - whole), pairs


def _marginals(n: int, cand, score, follow: np.ndarray | None = None) -> np.ndarray:
    """P(segment, kind) under the field, by forward and backward sums in log space."""
    return _forward_backward(n, cand, score, np.zeros((score.shape[1],) * 2) if follow is None else follow)[0]


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Generated sentences with their true spans, entities among words and decoys."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvwé") for _ in range(r.randint(2, 9)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k - 2)) + "4f"

    def card() -> str:
        d = r.choice("345") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return d if r.random() < .6 else r.choice(" -").join(d[k:k + 4] for k in range(0, 16, 4))

    def entity() -> tuple[str, str, str]:
        k = r.choice(("email", "obfuscated", "ip", "card", "phone", "phone", "national", "national", "secret", "secret", "ssn", "iban"))
        dom = f"{word()}{r.choice(['', num(1)])}.{r.choice(['example.com', 'org', 'net', 'co.uk'])}".replace("é", "e")
        who = word().replace("é", "e") + r.choice(["", "." + num(2), "_" + num(1), "-x"])
        if k == "email":
            return "", f"{who}@{dom}", k
        if k == "obfuscated":
            at, dot = r.choice(((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " dot ")))
            plain = lambda: word().replace("é", "e")
            return "", f"{r.choice((plain(), plain() + dot + plain()))}{at}{r.choice((plain(), plain() + dot + plain()))}{dot}{r.choice(['com', 'org', 'net'])}", "email"
        if k == "ip":
            return "", ".".join(str(r.randint(0, 255)) for _ in range(4)), k
        if k == "card":
            return "", card(), k
        if k == "phone":
            return "", r.choice((f"+1 ({num(3)}) 555-{num(4)}", f"+49 {num(3)} {num(7)}", f"+{num(2)}-{num(3)}-{num(3)}-{num(4)}")), k
        if k == "national":
            return r.choice(("", "call ", "phone: ", "tel. ")), r.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}")), "phone"
        if k == "secret":
            h = hexa(r.choice((16, 18, 20, 32, 40, 48, 64)))
            return r.choice((f"password={h}", f"password: {h}", f'token = "{h}"', f"api key {h}", f"secret = '{h}'")).split(h)[0], h, k
        if k == "ssn":
            return r.choice(("ssn ", "SSN: ", "")), f"{num(3)}-{num(2)}-{num(4)}", k
        return r.choice(("IBAN ", "iban: ", "")), f"{r.choice(['DE', 'GB', 'FR'])}{num(2)} " + " ".join(num(4) for _ in range(r.choice((3, 4, 4, 5)))) + r.choice(("", "", f" {num(2)}", f" {num(3)}")), k

    def numbers() -> str:
        """Numbers that are nobody's: tables, dates, times, book numbers, versions, measures."""
        day = f"{r.randint(1900, 2099)}{r.choice('-/.')}{r.randint(1, 12):02d}{r.choice('-/.')}{r.randint(1, 28):02d}"
        return r.choice((
            ",".join(r.choice((day, f"0.{num(4)}", num(r.randint(1, 8)), f"{num(2)}.{num(r.randint(1, 6))}", word())) for _ in range(r.randint(2, 5))),
            "\t".join(num(r.randint(1, 9)) for _ in range(3)), " ".join(num(r.randint(1, 4)) for _ in range(r.randint(2, 7))), day, f"{day} {num(2)}:{num(2)}:{num(2)}",
            f"{day}T{num(2)}:{num(2)}:{num(2)}.{num(3)}Z", "-".join((r.choice(("0", "1", "978")), num(r.randint(2, 3)), num(5), num(1))), f"ISBN 978-{num(1)}-{num(3)}-{num(5)}-{num(1)}",
            f"{num(1)}.{num(2)}.{num(1)}", f"v{num(1)}.{num(2)}.{num(1)}-rc{num(1)}", f"{num(3)} {num(3)} {num(3)}", f"{num(1)},{num(3)},{num(3)}.{num(2)}",
            f"{num(2)}.{num(6)}, {num(2)}.{num(6)}", f"{num(4)}-{num(4)}", f"{num(10)}", f"pp. {num(3)}-{num(3)}", f"{num(4)}/{num(2)}", f"1:{num(2)}.{num(2)}", f"§ {num(1)}.{num(1)}.{num(1)}",
            f"{num(5)}-{num(2)}", f"{word()}-{num(3)}-{num(4)}-{word()}", f"{num(2)}x{num(2)}x{num(2)}", f"3.{num(12)}", f"{num(2)}%", f"(1.{num(1)})",
            "-".join(hexa(k) for k in (8, 4, 4, 4, 12)), f"{word()}-{num(4)}-{word()}-{num(2)}", f"{word()}_{num(3)}.{word()}"))

    def decoy() -> str:
        return numbers() if r.random() < .6 else r.choice((num(r.randint(1, 6)), num(r.choice((9, 13, 16))), f"{num(1)}.{num(2)}", f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}:{num(2)}",
                         f"v{num(1)}.{num(1)}.{num(1)}", f"@{word()}", f"({num(4)})", f"{word()}{num(2)}", f"{num(3)},{num(3)}", f"{num(1)} at {num(2)}",
                         f"a dot and {num(2)}", hexa(6), f"1.{num(3)}.{num(3)}", f"{word()} at the dot", f"{num(5)}-{num(4)}", f"key {word()}", f"${num(3)}.{num(2)}"))

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 4)):
            text += " ".join(word() for _ in range(r.randint(1, 5))) + r.choice((" ", ", ", ". "))
            if r.random() < .55:
                cue, e, k = entity()
                spans.append((len(text) + len(cue), len(text) + len(cue) + len(e), k))
                text += cue + e + ('"' if cue.endswith('"') else "'" if cue.endswith("'") else "") + r.choice((" ", ", ", ". ", " "))
            elif r.random() < .7:
                text += decoy() + r.choice((" ", ", ", ". "))
        out.append((text + word(), spans))
    return out


def train(n: int = 1000, seed: int = 1, epochs: int = 6, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Weights (kinds, features) that maximise the regularised likelihood of the generated
    sentences, by adaptive gradient steps in a fixed order."""
    data = []
    for text, spans in examples(n, seed):
        toks, cand, feats = segments(text, 0, len(text))
        truth, pairs = np.zeros((len(cand), len(KINDS))), np.zeros((len(KINDS), len(KINDS)))
        ends: dict[int, int] = {}
        for c, (i, j) in enumerate(cand):
            for s, e, k in spans:
                if toks[i][0] == s and toks[j][1] == e:
                    truth[c, KINDS.index(k)] = 1
                    if i in ends:
                        pairs[ends[i], KINDS.index(k)] += 1
                    ends[j + 1] = KINDS.index(k)
        if cand:
            data.append((len(toks), cand, feats, truth, pairs))
    w, norm = np.zeros((len(KINDS), WEIGHTS + len(KINDS))), np.full((len(KINDS), WEIGHTS + len(KINDS)), 1e-2)
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(data)
        for m, cand, feats, truth, pairs in data:
            expected, follows = _forward_backward(m, cand, _scores(w, feats), _follow(w))
            step = truth - expected
            ids, inverse = np.unique(feats, return_inverse=True)
            grad = np.zeros((len(KINDS), len(ids)))
            np.add.at(grad.T, inverse.reshape(feats.shape).ravel(), np.repeat(step, feats.shape[1], axis=0))
            for at, g in ((ids, grad), (slice(WEIGHTS, None), (pairs - follows).T)):
                g = g - decay * w[:, at]
                norm[:, at] += g ** 2
                w[:, at] += rate * g / np.sqrt(norm[:, at])
    return w


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """The runs of a text, as its parts; no candidate crosses their ends."""
    for toks, _, first, stop in _line_runs(text):
        yield toks[first][0], toks[stop - 1][1]


def field_spans(text: str, w: np.ndarray, batch: int = 4000) -> list[tuple[int, int, str]]:
    """The entities the field finds in a whole text."""
    out, follow = [], _follow(w)
    spare = -2 * max(0.0, float(follow.max()))  # a segment below this only costs, whatever is beside it
    for toks, props, first, stop in _line_runs(text):
        cand: list[tuple[int, int]] = []
        scored: list[np.ndarray] = []
        for at in range(first, stop, batch):  # a long run is scored in pieces of bounded size
            c, f = _candidates(text, toks, props, first, stop, at, min(stop, at + batch))
            if c:
                s = _scores(w, np.array(f))
                keep = np.nonzero(s.max(axis=1) > spare)[0]
                cand += [(c[k][0] - first, c[k][1] - first) for k in keep]
                scored.append(s[keep])
        if cand:
            out += [(toks[first + i][0], toks[first + j][1], KINDS[k]) for i, j, k in decode(stop - first, cand, np.concatenate(scored), follow)]
    return out


def find(text: str, w: np.ndarray) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and all spans: those and what the field adds beside them."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    taken = sorted((s, e) for s, e, _ in base)
    reach, most = [], 0
    for s, e in taken:
        reach.append(most := max(most, e))
    starts = np.array([s for s, _ in taken])
    added = []
    for s, e, k in field_spans(text, w):
        before = int(np.searchsorted(starts, e)) if taken else 0  # base spans that start before e
        if not before or reach[before - 1] <= s:
            added.append((s, e, k))
    return base, sorted(base + added, key=lambda x: (x[0], KINDS.index(x[2])))


def search(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """doc_id, spans array<struct<start,end,kind,base>> for one row per row of ``docs``."""
    w = docs.sparkSession.sparkContext.broadcast(train() if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))
        for b in batches:
            rows = []
            for t in b.column(1):
                base, every = find(t.as_py(), w.value)
                fixed = {*base}
                rows.append([{"start": s, "end": e, "kind": k, "base": (s, e, k) in fixed} for s, e, k in every])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long,kind:string,base:boolean>>")


def told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def base_digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(told(spans).encode()).hexdigest()
