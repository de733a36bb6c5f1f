"""Personal data replaced by keyed surrogates of the same type and format.

Detection finds e-mail addresses, phone numbers, IP addresses, card and other long account
numbers, IBANs, social security numbers, secrets (tokens, keys, passwords) and person names (after
an honorific or a phrase that introduces a person, before a Chinese form of address, or a listed given name
followed by a surname; a name that only its shape shows stays). Each entity has a normal form, so
that every way of writing it is one entity (coreference): country code and digits for phone numbers, digits only for other
numbers, lower case and all groups for addresses, one component for each part of a name, whichever title stands before it.
Later mentions of either component alone are found too.

A surrogate is a keyed function of type, normal form and attempt: letters become letters of the
same script and case, digits digits, separators stay; card numbers keep whether their check digit
holds, IBANs get a right one. A given name's gender belongs to the entity: the listed one, else the one its titles
in the whole table say (female, if they differ), else by its ending; its surrogate has that gender's endings. Over the whole table the
distinct entities are checked for collisions - two entities with one surrogate, or a surrogate
that is an entity of the table - and the later of them (by attempt, then normal form) tries again
until none is left, so distinct entities stay distinct. Where the forms of a type are few, later
attempts draw from more of them (longer strings and numbers, other address ranges), so the rounds
end also when every form is taken. The attempts that are not 0 are few; they
reach the tasks as a broadcast while under ``broadcast_entities`` (counted first), else by a join.

Defined cases: null texts stay null and empty texts empty, with no entities; very long texts are
searched whole; repeated rows are replaced alike; strings without a letter or digit to change
(masked passwords, rules of dashes) are no entities; overlapping finds keep the earliest, then the
longest; an empty table gives an empty result; all columns of the input pass through unchanged
except the text. Without entities a text is unchanged byte for byte.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ._util import bound_batches, free_name, stage, without

#: Key of the surrogates; production passes its own secret.
DEFAULT_KEY = b"surrogate key for tests"
HONORIFICS = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f",
              "Mme": "f", "Mademoiselle": "f", "Señora": "f", "Señorita": "f", "Dr": "n", "Prof": "n"}
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Olivia Sophia Isabella Charlotte Amelia Julia Katharina Claudia Sabine Camille Chloé Juliette María Carmen Lucía Анна Мария Елена Ольга".split(),
    "m": "James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Anthony Andrew Jürgen Wolfgang Stefan Klaus Pierre Jacques François Louis Carlos José Miguel Antonio Иван Дмитрий Сергей Михаил".split(),
}
_GENDER = {name: g for g, names in GIVEN.items() for name in names}
_SECRET_WORDS = ("token", "secret", "passw", "pwd", "api_key", "apikey", "api-key", "access_key", "private_key", "auth_key")

_EMAIL = regex.compile(r"[\p{L}\p{N}][\p{L}\p{N}._%+'-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_ASSIGNED = regex.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|(?:access|private|auth)_key)[\"']?\s*[:=]\s*[\"']?([^\s\"'|]{6,})")
_KNOWN = regex.compile(r"\b(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,})")
_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*(.+?)\s*-----END", re.S)
_NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,2}|\d{2,4}(?:[ .-]?\d{2,4}){1,3})(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\d.,/-])(?<!\d )\d{3} \d{3} \d{4}(?![\d/-]|[.,]\d| \d)|(?<![\d.,/-])(?<!\d )0\d{2,4}[ /-]\d{6,8}(?![\d/-]|[.,]\d| \d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d])(?:\d{13,19}|\d{4}([ -])\d{4}\5\d{4}\5\d{1,7}|\d{4}([ -])\d{6}\6\d{5})(?!\d))"
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}(?![0-9A-Za-z:.])")
#: Country codes of one and two digits (fixed values, ITU E.164); all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
#: A name's word: capital, perhaps O' or parts joined by hyphens; a possessive 's is no part of it.
_CAP = r"(?:\p{Lu}['’](?=\p{Lu}))?\p{Lu}\p{Ll}+(?:[-’']\p{Lu}\p{Ll}+)*"
#: Phrases after which a person's name stands.
_CUES = r"(?:[Mm]y name is|[Nn]ame ?:|[Aa]uthor ?:|[Cc]ontact ?:|[Ss]incerely,|[Rr]egards,|[Ss]igned,|[Ii]ch heiße|[Mm]ein [Nn]ame ist|[Jj]e m['’]appelle|[Mm]e llamo|[Mm]i nombre es|[Мм]еня зовут)"
_NAME = regex.compile(r"(?<![\p{L}])(?:(?P<title>" + "|".join(HONORIFICS) + rf")\.?[ ]+(?P<one>{_CAP})(?:[ ](?P<two>{_CAP}))?|(?P<given>" + "|".join(_GENDER) + rf")[ ](?P<sur>{_CAP})|{_CUES}\s+(?P<first>{_CAP})(?:[ ](?P<last>{_CAP}))?)(?![\p{{L}}])")
#: The commonest Chinese family names (a list, extended by its users) before a form of address, or any name after an introduction.
_HAN_FAMILY = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文"
_HAN = regex.compile(rf"(?:[{_HAN_FAMILY}]\p{{Han}}{{1,2}}(?=先生|女士|小姐|教授|老师|医生|博士))|(?<=我叫|名叫|名字是)[{_HAN_FAMILY}]\p{{Han}}{{1,2}}")
_DIGIT = re.compile(r"\d")
_LEAD = re.compile(r"AKIA|gh[pousr]_|sk-|xox[abprs]-|eyJ")


def _changeable(kind: str, norm: str) -> bool:
    """Whether a surrogate of this entity can differ from it."""
    if kind == "secret":
        lead = _LEAD.match(norm)
        norm = norm[lead.end():] if lead else norm
    elif kind == "email":
        norm = norm.rpartition(".")[0]
    else:
        return True
    return any(c.isalpha() or c.isdecimal() for c in norm)


def phone_form(written: str) -> str:
    """Digits of a phone number, after its country code and a space where it is written with one."""
    digits = re.sub(r"\D", "", written)
    if written[0] != "+":
        return digits
    n = next((k for k in (1, 2) if digits[:k] in _CODES), 3)
    return f"+{digits[:n]} {digits[n:]}"


def ip6_form(written: str) -> str | None:
    """All groups of an IPv6 address; None if it is none, or names no host (``::``, ``::1``)."""
    if sum(map(bool, written.split(":"))) < 3:
        return None
    try:
        return ipaddress.IPv6Address(written).exploded
    except ValueError:
        return None


def gender_of(name: str) -> str:
    """Gender of a given name (lower case): the listed one, else by its ending."""
    listed = _GENDER.get(name.capitalize())
    return listed or ("f" if name.endswith(("a", "ie", "ette", "elle", "ine", "я", "а")) else "m")


def find_entities(text: str, genders: dict[str, str] | None = None) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, normal form)`` of the entities of a whole text, in order, without overlaps.

    ``genders`` takes up what titles say of given names that are not listed.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    low = text.lower()
    if any(w in low for w in _SECRET_WORDS):
        found += [(*m.span(1), "secret", m[1]) for m in _ASSIGNED.finditer(text)]
    if "PRIVATE KEY" in text:
        found += [(*m.span(1), "secret", m[1]) for m in _PEM.finditer(text)]
    if any(w in text for w in ("AKIA", "gh", "sk-", "xox", "eyJ")):
        found += [(*m.span(1), "secret", m[1]) for m in _KNOWN.finditer(text)]
    if _DIGIT.search(text):
        found += [(*m.span(), "secret", m[0]) for m in _HEX.finditer(text) if not m[0].isdigit()]
        for m in _NUMBER.finditer(text):
            kind = m.lastgroup or ("ip" if m["ip"] else "phone" if m["phone"] else "ssn" if m["ssn"] else "card")
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            norm = m[0] if kind == "ip" else phone_form(m[0]) if kind == "phone" else re.sub(r"\D", "", m[0])
            found.append((*m.span(), kind, norm))
        found += [(*m.span(), "iban", m[0].replace(" ", "")) for m in _IBAN.finditer(text)]
    if "::" in text or text.count(":") >= 7:
        found += [(*m.span(), "ip6", form) for m in _IP6.finditer(text) if (form := ip6_form(m[0]))]
    for m in _NAME.finditer(text):
        if m["given"]:
            parts = [("given", "given"), ("sur", "surname")]
        elif m["first"]:
            parts = [("first", "given"), *([("last", "surname")] if m["last"] else [])]
        elif m["two"]:
            parts = [("one", "given"), ("two", "surname")]
            gender = HONORIFICS[m["title"]]
            if genders is not None and gender != "n" and m["one"].capitalize() not in _GENDER:
                genders[m["one"].lower()] = min(gender, genders.get(m["one"].lower(), gender))
        else:
            parts = [("one", "surname")]
        found += [(*m.span(g), kind, m[g].lower()) for g, kind in parts]
    if not text.isascii():
        found += [(*m.span(), "surname", m[0]) for m in _HAN.finditer(text)]
    named = {text[s:e]: k for s, e, k, _ in found if k in ("surname", "given")}
    if named:  # later mentions by one component alone
        again = regex.compile(r"(?<![\p{L}])(?:" + "|".join(map(regex.escape, sorted(named, key=len, reverse=True))) + r")(?![\p{L}--\p{Han}])", regex.V1)
        found += [(*m.span(), named[m[0]], m[0].lower()) for m in again.finditer(text)]
    found = [x for x in found if _changeable(x[2], x[3])]
    if len(found) > 1:
        found.sort(key=lambda x: (x[0], -x[1]))
        clear, end = [], -1
        for x in found:
            if x[0] >= end:
                clear.append(x)
                end = x[1]
        found = clear
    return found


class _Draw:
    """Keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, norm: str, attempt: int):
        self.key, self.message, self.n, self.left = key, f"{kind}\x00{attempt}\x00{norm}\x00".encode("utf-8", "surrogatepass"), 0, b""

    def __call__(self, below: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.message + str(self.n).encode(), hashlib.sha256).digest()
            self.n += 1
        got, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return got % below


_ALPHABETS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшщэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω",
              "HEBREW": "אבגדהוזחטיכלמנסעפצקרשת", "ARABIC": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"}
_SYLLABLES = {
    "LATIN": ("ba be bo ca co da de do fa fe ga go ha ke la le lo ma me mi mo na ne no pa pe ra re ri ro sa se si so ta te ti to va ve vi wa".split(), {"f": ["lia", "nna", "ssa", "rina"], "m": ["ron", "las", "rik", "bert"], "n": ["rin", "len"], "s": ["rman", "ster", "wick", "lund", "mont", "ley"]}),
    "CYRILLIC": ("ба бо ва га да до за ка ко ла ле ло ма ми мо на не но па по ра ро са се со та то".split(), {"f": ["лина", "рия", "нна"], "m": ["слав", "мир", "рей"], "n": ["лен"], "s": ["ров", "нин", "ский"]}),
}


def script_of(c: str) -> str:
    return unicodedata.name(c, "LATIN").split(" ", 1)[0]


def _like(c: str, draw: _Draw) -> str:
    """A character of the same class, script and case."""
    if c.isdecimal():
        return chr(ord(c) - unicodedata.decimal(c) + draw(10))
    if not c.isalpha():
        return c
    letters = _ALPHABETS.get(script_of(c))
    if letters:
        x = letters[draw(len(letters))]
        return x.upper() if c.isupper() else x
    for _ in range(16):  # other scripts: a letter of the same code block
        x = chr((ord(c) & ~0x7F) + draw(128))
        if x.isalpha() and script_of(x) == script_of(c):
            return x
    return _ALPHABETS["LATIN"][draw(26)]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def surrogate(kind: str, norm: str, attempt: int, key: bytes, gender: str = "") -> str:
    """Replacement of a normal form: a function of the key, the type, the form, the attempt, and a given name's gender."""
    draw = _Draw(key, kind, norm, attempt)
    more = attempt // 4  # a wider space for entities whose own is taken
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        labels = domain.split(".")
        return "".join(_like(c, draw) for c in local + "a" * more) + "@" + ".".join(["".join(_like(c, draw) for c in x) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        parts = norm.split(".")
        keep = 1 if parts[0] in ("10", "127") else 2 if parts[:2] == ["192", "168"] else 0
        if more and keep:  # another private range, then any
            parts, keep = ["10", *parts[1:]], 1 if more < 3 else 0
        return ".".join(parts[:keep] + [str(1 + draw(254)) for _ in parts[keep:]])
    if kind == "ip6":
        return ":".join("".join("0123456789abcdef"[draw(16)] for _ in x) for x in norm.split(":"))
    if kind == "card":
        body = norm[0] + "".join(str(draw(10)) for _ in norm[1:-1])
        good = next(str(d) for d in range(10) if luhn(body + str(d)))
        return body + (good if luhn(norm) else str((int(good) + 1 + draw(9)) % 10))
    if kind == "iban":
        body = "".join(_like(c, draw) for c in norm[4:] + "0" * more)
        number = int("".join(str(int(c, 36)) for c in body + norm[:2] + "00"))
        return f"{norm[:2]}{98 - number % 97:02d}{body}"
    if kind == "secret":
        lead = _LEAD.match(norm)
        n = lead.end() if lead else 0
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", norm):
            digits = "0123456789ABCDEF" if norm.upper() == norm else "0123456789abcdef"
            return "".join(digits[draw(16)] for _ in norm + "0" * more)
        return norm[:n] + "".join(_like(c, draw) for c in norm[n:] + "a" * more)
    if kind in ("surname", "given"):
        script = script_of(norm[0])
        if script not in _SYLLABLES:
            return "".join(_like(c, draw) for c in norm + norm[0] * more)
        syllables, ends = _SYLLABLES[script]
        tail = ends["s" if kind == "surname" else gender or gender_of(norm)]
        return "".join(syllables[draw(len(syllables))] for _ in range(2 + more)) + tail[draw(len(tail))]
    code, _, rest = norm.rpartition(" ")  # phone, ssn: the digits but for a country code
    trunk = "0" * (kind == "phone" and rest[:1] == "0")  # the zero before an area code stays
    return f"{code} " * bool(code) + trunk + "".join(_like(c, draw) for c in rest[len(trunk):] + "0" * more)


def write_like(original: str, kind: str, form: str) -> str:
    """The surrogate's normal form in the writing of the original (separators and case)."""
    if kind in ("phone", "ssn", "card", "iban"):
        chars = iter(re.sub(r"[+ ]", "", form))
        return "".join([next(chars) if c.isalnum() else c for c in original]) + "".join(chars)
    if kind == "ip6" and len(original) != len(form):  # written short: without leading zeros
        form = ":".join(format(int(x, 16), "x") for x in form.split(":"))
        return form.upper() if original.upper() == original else form
    if kind in ("email", "ip6"):
        return "".join(x.upper() if c.isupper() else x for c, x in zip(original, form)) if len(original) == len(form) else form
    if kind in ("surname", "given"):
        return form.upper() if original.isupper() and len(original) > 1 else form[:1].upper() + form[1:]
    return form


def _drawn(drawn: dict[tuple[str, str], tuple[int, str]], kind: str, norm: str, key: bytes) -> tuple[int, bytes, str]:
    attempt, gender = drawn.get((kind, norm), (0, ""))
    return attempt, key, gender


def replace_entities(text: str, key: bytes, drawn: dict[tuple[str, str], tuple[int, str]]) -> tuple[str, int]:
    """The text with its entities replaced, and how many there were."""
    found = find_entities(text)
    if not found:
        return text, 0
    out, at = [], 0
    for start, end, kind, norm in found:
        out += [text[at:start], write_like(text[start:end], kind, surrogate(kind, norm, *_drawn(drawn, kind, norm, key)))]
        at = end
    return "".join(out) + text[at:], len(found)


def entity_attempts(docs: DataFrame, key: bytes) -> DataFrame:
    """``kind, norm, attempt, gender`` of every distinct entity of ``docs``, free of collisions (gender: only where titles gave it).

    Rounds go on until none is left: each fourth attempt of an entity draws from a wider space, so no space stays full.
    """

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen, genders = set(), {}
            for t in b["text"]:
                if t:
                    seen.update((k, n) for _, _, k, n in find_entities(t, genders))
            yield pd.DataFrame([(k, n, genders.get(n) if k == "given" else None) for k, n in sorted(seen)], columns=["kind", "norm", "gender"])

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(form=[surrogate(k, n, a, key, g or "") for k, n, g, a in zip(b["kind"], b["norm"], b["gender"], b["attempt"])])

    schema = "kind string, norm string, gender string, attempt int, form string"
    found = docs.select("text").where("text <> ''").mapInPandas(detect, "kind string, norm string, gender string").groupBy("kind", "norm").agg(F.min("gender").alias("gender"))
    e = stage(found.withColumn("attempt", F.lit(0)).mapInPandas(draw, schema), "entities")
    while True:
        first = e.groupBy("kind", "form").agg(F.min(F.struct("attempt", "norm")).alias("w"), F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = e.join(first, ["kind", "form"]).where((F.col("norm") != F.col("w.norm"))).select("kind", "norm")
        known = e.select("kind", F.col("norm").alias("form"))
        real = e.join(known, ["kind", "form"], "left_semi").select("kind", "norm")
        bad = stage(shared.union(real).distinct().withColumn("again", F.lit(True)), "collisions")
        if bad.isEmpty():
            return e.select("kind", "norm", "attempt", "gender")
        step = e.join(bad, ["kind", "norm"], "left").select("kind", "norm", "gender", (F.col("attempt") + F.when(F.col("again"), 1).otherwise(0)).cast("int").alias("attempt"))
        e = stage(step.mapInPandas(draw, schema), "entities")


def replace_pii(docs: DataFrame, key: bytes = DEFAULT_KEY, broadcast_entities: int = 200_000, count: str | None = "n_entities") -> DataFrame:
    """``docs`` (all columns) with surrogates in ``text``; ``count`` names a column for the number of entities (None: no such column)."""
    bound_batches(docs.sparkSession)
    docs = without(docs, count) if count else docs
    again = entity_attempts(docs, key).where("attempt > 0 OR gender IS NOT NULL")
    columns, at = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, *([T.StructField(count, T.LongType())] if count else [])])
    small = again.count() <= broadcast_entities

    def run(batches: Iterator[pa.RecordBatch], attempts: dict | None) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(len(columns)).to_pylist() if attempts is None else None
            texts, numbers = [], []
            for i, t in enumerate(b.column(at).to_pylist()):
                redo = attempts if own is None else {(x["kind"], x["norm"]): (x["attempt"], x["gender"] or "") for x in own[i] or ()}
                new, n = replace_entities(t, key, redo) if t else (t, 0)
                texts.append(new)
                numbers.append(n)
            out = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array(numbers, pa.int64())] if count else [])], names=schema.names)

    if small:
        attempts = {(r[0], r[1]): (r[2], r[3] or "") for r in again.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(attempts)
        return docs.mapInArrow(lambda batches: run(batches, shared.value), schema)

    def detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = {(text_key(t), k, n) for t in b["text"] if t for _, _, k, n in find_entities(t)}
            yield pd.DataFrame(sorted(rows), columns=["text_key", "kind", "norm"])

    held = docs.select("text").where("text <> ''").mapInPandas(detect, "text_key string, kind string, norm string").distinct()
    per_text = held.join(again, ["kind", "norm"]).groupBy("text_key").agg(F.collect_list(F.struct("kind", "norm", "attempt", "gender")).alias("_redo"))  # bounded by a text
    name, redo = free_name(docs, "text_key"), free_name(docs, "_redo")
    keyed = docs.withColumn(name, F.sha2(F.col("text").cast("binary"), 256))
    per_text = per_text.select(F.col("text_key").alias(name), F.col("_redo").alias(redo))
    joined = keyed.join(per_text, name, "left").select(*[keyed[c] for c in columns], redo)
    return joined.mapInArrow(lambda batches: run(batches, None), schema)


def text_key(text: str) -> str:
    """Name of a text (as Spark's sha2 gives it)."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
