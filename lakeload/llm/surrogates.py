"""Surrogates for personal data: keyed, of the same type and form, distinct, and the same for each mention.

Detected entities (e-mail addresses, phone, card and social security numbers, IBANs, IPv4 addresses, access keys,
labelled secrets, titled names) are replaced by surrogates drawn from a keyed hash of the entity's canonical value.
The canonical value drops what only formats it (case of an e-mail, spaces in a number), so every mention of an
entity gets the same surrogate, written in that mention's own format. Names keep gender (from the title) and
script (Latin for any other than Cyrillic), initials become other initials (not distinct), cards their check digit, IBANs country and check digits, addresses the length of each part.

A name is found after a title, with initials, particles, apostrophes and letters of any script; the words of such a
name are replaced wherever else the same document has them with a capital, save function words. A digit run counts
as a card only with a right check digit. Names that never have a title in their document are not found.

Collisions are checked over the corpus: no surrogate equals another entity's surrogate or any original of its
kind. One row per distinct entity is aggregated by surrogate; of those that clash all but the first draw again,
until none is left (each round is written to the shared folder). Entities that had to draw again are few, but no
bound is assumed: they reach the documents by a join whose strategy Spark chooses by size, and only documents that
hold one carry a list. All other surrogates need no table. Texts are read twice and shuffled only if the
list of redrawn entities is too big to broadcast.

Nulls and edge cases: a null text stays null, with 0 entities; null ids are kept; a document is a distinct (id,
text), repeated rows share the result; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import stage

RELAXED, ROUNDS = 20, 60  # draws after which the form may change, and after which the job fails

_LOCAL, _DOMAIN = re.compile(r"[\w.+%-]+"), re.compile(r"(?:[\w-]+\.)+[^\W\d_]{2,}")
_DIGITS = re.compile("[0-9]+")
_NUMBER = re.compile(
    r"(?:"
    r"(?P<phone>\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\+[1-9]\d{7,14}"
    r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|[2-9]\d{2} [2-9]\d{2} \d{4})"
    r"|(?P<ip>(?:\d{1,3}\.){3}\d{1,3})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
    r"|(?P<card>\d(?:[ -]?\d){12,18})"
    r")(?![\w]|\.\d|-\d)"
)
_KEY = re.compile(r"(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])")
_SECRET_WORDS = ("pass", "pwd", "token", "secret", "key")
_SECRET = re.compile(
    r"(?i)(?:(?<![^\W_])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"
    r"(?:password|passwd|pwd|token|secret|(?:api|access|secret|private|auth)[_-]?key)[\"']?\s*[=:]\s*[\"']?(?P<secret>[\w+/.-]{8,}=*)"
)
# fixed values: titles and the gender they tell
_TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Mlle", "Sra", "Señora", "Doña", "г-жа", "госпожа"],
    "m": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Sr", "Señor", "Don", "г-н", "господин"],
    "n": ["Dr", "Prof"],
}
_GENDER = {t: g for g, ts in _TITLES.items() for t in ts}


def _letters(wanted) -> str:
    """Ranges of a character class: the letters for which ``wanted`` holds."""
    codes = [c for c in range(0x110000) if chr(c).isalpha() and wanted(chr(c))]
    starts = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -2]) if c + 1 != after]
    return "".join(f"{chr(x)}-{chr(y)}" for x, y in zip(starts, ends))


# a name word begins with a letter that is not lower case; letters may have accents of their own and apostrophes between
_UP = f"[{_letters(lambda c: not c.islower())}]"
_CAP = rf"{_UP}[\u0300-\u036f]*(?:['’]?[^\W\d_][\u0300-\u036f]*)+"
_INITIALS = rf"(?:{_UP}(?:\. ?| (?={_UP}))){{0,3}}"
_BETWEEN = "(?:(?:von|van|vom|zu|der|den|ter|ten|de|del|della|di|da|das|dos|du|la|le|el|bin|ibn) ){0,3}"
_PERSON = re.compile(
    rf"({'|'.join(sorted(_GENDER, key=len, reverse=True))})\.? ({_INITIALS}{_BETWEEN}{_CAP}(?:[ -]{_INITIALS}{_BETWEEN}{_CAP}){{0,2}})"
)
_NAME, _NAME_OR_INITIAL = re.compile(_CAP), re.compile(rf"{_CAP}|{_UP}")
# words that are no name when they stand without a title
_COMMON = set("The This That These Those You We He She It They And Or But In On At To Of For From With By As Is Are Was Not No If So Der Die Das Und Ich Sie Er Wir El La Los Las Un Una Y Le Les Et Je Il Elle Nous Vous И В На Не Что Это Он Она Мы Вы".split())

_NAMES = {
    ("f", "latin"): "Ada Alma Anna Berta Carla Clara Dora Edith Elena Elsa Emma Erika Flora Frida Greta Hanna Helen Ida Irene Julia Laura Lena Lucia Maria Marta Mona Nadia Nora Olga Paula Petra Rita Rosa Sara Silvia Sofia Tina Vera Wanda Zita",
    ("m", "latin"): "Adam Alan Anton Arno Bruno Carl Conrad Daniel David Denis Edgar Emil Erik Felix Frank Georg Hans Henry Hugo Ivan Jacob Jonas Karl Leo Lucas Marco Martin Max Noah Oscar Otto Paul Peter Ralf Robert Simon Stefan Theo Victor Walter",
    ("f", "cyrillic"): "Алла Анна Вера Галина Дарья Ева Елена Зоя Инна Ирина Лидия Мария Нина Ольга Полина Раиса София Тамара Юлия Яна",
    ("m", "cyrillic"): "Алексей Антон Борис Вадим Виктор Глеб Денис Егор Иван Игорь Кирилл Лев Максим Марк Олег Павел Роман Семён Тимур Юрий",
}
_NAMES = {k: v.split() for k, v in _NAMES.items()}
for _s in ("latin", "cyrillic"):
    _NAMES["n", _s] = _NAMES["f", _s] + _NAMES["m", _s]
_SYLLABLES = {
    "latin": [a + b for a in ("b", "br", "d", "f", "g", "gr", "h", "k", "l", "m", "n", "p", "r", "s", "st", "t", "v", "w") for b in ("a", "e", "i", "o", "u")],
    "cyrillic": [a + b for a in ("б", "в", "г", "д", "ж", "к", "л", "м", "н", "п", "р", "с", "т") for b in ("а", "е", "и", "о", "у")],
}
_LAST = {"latin": ["n", "r", "s", "l", "ck", "m"], "cyrillic": ["н", "р", "с", "л", "к", "м"]}


def luhn_ok(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text, in order, without overlaps."""
    got = []
    at = text.find("@")
    while at >= 0:
        start = at
        while start and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if domain and start < at:
            got.append((start, domain.end(), "email", text[start : domain.end()].lower()))
        at = text.find("@", at + 1)
    if "AKIA" in text or "ASIA" in text:
        got += [(m.start(), m.end(), "key", m[0]) for m in _KEY.finditer(text)]
    if "=" in text or ":" in text:
        low = text.lower()
        if any(w in low for w in _SECRET_WORDS):
            got += [(*m.span("secret"), "secret", m["secret"]) for m in _SECRET.finditer(text)]
    digits = _DIGITS.search(text)
    while digits:  # numbers are tried where a run of digits begins, with what may stand before it
        at, until = digits.span()
        for back in (2, 1, 0):
            m = _NUMBER.match(text, at - back) if at >= back and (not back or text[at - back] not in "0123456789 ") else None
            if m and not (at > back and (text[at - back - 1].isalnum() or text[at - back - 1] in "_.+")):
                kind, value = m.lastgroup, m[0]
                if kind == "ip" and any(int(x) > 255 for x in value.split(".")):
                    continue
                if kind == "card" and not luhn_ok(re.sub("[^0-9]", "", value)):
                    continue
                if kind == "iban" and not _iban_ok(value.replace(" ", "")):
                    continue
                got.append((m.start(), m.end(), kind, value if kind == "ip" else re.sub(r"[^0-9A-Z]", "", value)))
                until = max(until, m.end())
                break
        digits = _DIGITS.search(text, until)
    known = {}
    for m in _PERSON.finditer(text):
        if m.start() and text[m.start() - 1].isalnum():
            continue
        words = [(w.start() + m.start(2), _own(w[0])) for w in _NAME_OR_INITIAL.finditer(m[2])]
        for k, (at, w) in enumerate(words):
            kind = "surname" if k == len(words) - 1 else "initial" if _is_initial(w) else "given-" + _GENDER[m[1]]
            got.append((at, at + len(w), kind, _cased(w)))
            if kind == "surname":
                known[_cased(w)] = kind
            elif kind != "initial":
                known.setdefault(_cased(w), kind)
    if known:  # the same names without a title
        for m in _NAME.finditer(text):
            w = _own(m[0])
            kind = known.get(_cased(w))
            if kind and _cased(w) not in _COMMON and not (m.start() and text[m.start() - 1].isalnum()):
                got.append((m.start(), m.start() + len(w), kind, _cased(w)))
    out, until = [], 0
    for e in sorted(got, key=lambda e: (e[0], -e[1])):  # at the same place, a name with its title comes first
        if e[0] >= until:
            out.append(e)
            until = e[1]
    return out


def _own(word: str) -> str:
    """A name word without the ending of the possessive."""
    return word[:-2] if len(word) > 3 and word[-2:] in ("'s", "’s") else word


def _is_initial(word: str) -> bool:
    return len(word) == 1


def _cased(word: str) -> str:
    """A name in capitals is the name."""
    return word.capitalize() if len(word) > 1 and word.isupper() else word


def _iban_ok(v: str) -> bool:
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


class _Draw:
    """A keyed stream of numbers for one (kind, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass")
        self.key, self.n, self.left = key, 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
            self.n += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x * n >> 32

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """A character of the same class for every letter and digit."""
        out = []
        for c in text:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                new = "abcdefghijklmnopqrstuvwxyz"[self.below(26)]
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value; later attempts draw anew, and in the end in freer form."""
    draw, freer = _Draw(key, kind, value, attempt), attempt >= RELAXED
    if kind == "email":
        local, domain = value.split("@", 1)
        labels = domain.split(".")
        # a domain keeps its last label, and is replaced alike for all its addresses
        of_domain = _Draw(key, "domain", domain, 0)
        labels = [of_domain.like(x) for x in labels[:-1]] + labels[-1:]
        more = draw.like("aaaa") if freer else ""
        return f"{draw.like(local)}{more}@{'.'.join(labels)}"
    if kind == "ip":
        low = lambda p: 0 if freer or len(p) == 1 else 10 ** (len(p) - 1)
        high = lambda p: 255 if freer or len(p) == 3 else 10 ** len(p) - 1
        return ".".join(str(low(p) + draw.below(high(p) - low(p) + 1)) for p in value.split("."))
    if kind == "card":
        new = value[0] + draw.like(value[1:])
        if luhn_ok(value):
            new = next(new[:-1] + d for d in "0123456789" if luhn_ok(new[:-1] + d))
        return new
    if kind == "phone":
        keep = 1 if len(value) == 11 else 0 if len(value) <= 10 else len(value) - 10
        return value[:keep] + str(2 + draw.below(8)) + draw.like(value[keep + 1 :])
    if kind == "iban":
        body = draw.like(value[4:])
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    if kind == "key":
        return value[:4] + draw.like(value[4:])
    if kind == "secret":
        return draw.like(value, re.fullmatch(r"[0-9a-f]+", value) is not None) + (draw.like("a0a0") if freer else "")
    if kind == "ssn":
        return draw.like(value)
    script = _script(value)
    if kind == "initial":  # another letter; letters are too few to differ from one another
        letters = "АБВГДЕЖЗИКЛМНОПРСТУФХЭЮЯ" if script == "cyrillic" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return letters[(letters.find(value) + 1 + draw.below(len(letters) - 1)) % len(letters)]
    if kind.startswith("given-"):
        pool = _NAMES[kind[-1], script]
        name = pool[draw.below(len(pool))]
        if attempt:  # the pool is small: later draws make compound names of the same gender
            name = "-".join([name, *(pool[draw.below(len(pool))] for _ in range(1 + attempt // 4))])
        return name
    syllables = _SYLLABLES[script]
    parts = [syllables[draw.below(len(syllables))] for _ in range(3 + attempt // 4)]
    return ("".join(parts) + _LAST[script][draw.below(6)]).capitalize()


def in_format(mention: str, kind: str, value: str, new: str) -> str:
    """The surrogate as the mention writes its value: same separators, same case of an e-mail."""
    if kind == "email" or kind == "surname" or kind.startswith("given-"):
        return new.upper() if len(mention) > 1 and mention.isupper() and mention.upper() != mention.lower() else new
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(new)
        return "".join(next(chars) if c.isalnum() and c.isascii() else c for c in mention)
    return new


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, dict[str, int], list]:
    """New text, number of entities by kind, and (start, end, kind) of the surrogates in the new text."""
    out, kinds, spans, at, size = [], {}, [], 0, 0
    for s, e, kind, value in find(text):
        new = in_format(text[s:e], kind, value, surrogate(key, kind, value, attempts.get((kind, value), 0)))
        out += [text[at:s], new]
        size += s - at
        spans.append((size, size + len(new), kind))
        size += len(new)
        kinds[kind] = kinds.get(kind, 0) + 1
        at = e
    return "".join(out) + text[at:], kinds, spans


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) -> the distinct entities of each document."""
    for b in batches:
        rows = [
            (d, h, kind, value)
            for d, h, t in zip(*(c.to_pylist() for c in b.columns))
            for kind, value in sorted({(k, v) for _, _, k, v in find(t or "") if k != "initial"})
        ]
        cols = list(zip(*rows)) if rows else [()] * 4
        kinds = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "text_hash", "kind", "value"])


def _drawn(key: bytes):
    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(kind, value, attempt) -> the same and the surrogate."""
        for b in batches:
            new = [surrogate(key, *r) for r in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], names=["kind", "value", "attempt", "new"])

    return drawn


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt) of the distinct entities (kind, value) whose first surrogate clashes."""
    schema = "kind string, value string, attempt int, new string"
    draw = lambda df, label: stage(df.select("kind", "value", "attempt").mapInArrow(_drawn(key), schema), label)
    all_ = draw(entities.withColumn("attempt", F.lit(0)), "surrogates")
    for _ in range(ROUNDS):
        # given names of different genders must differ as well
        group = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
        rows = all_.withColumn("g", group)
        first = rows.groupBy("g", "new").agg(F.min(F.struct("attempt", "kind", "value")).alias("first"), F.count("*").alias("n"))
        first = first.filter("n > 1")
        originals = rows.select(F.col("g"), F.col("value").alias("new")).distinct()
        later = rows.join(first, ["g", "new"]).filter(F.struct("attempt", "kind", "value") != F.col("first")).select("kind", "value")
        real = rows.join(originals, ["g", "new"], "left_semi").select("kind", "value")
        clash = stage(later.union(real).distinct(), "surrogate-clashes")
        if clash.isEmpty():
            return all_.filter("attempt > 0").select("kind", "value", "attempt")
        again = clash.select("kind", "value", F.lit(1).alias("more"))
        bumped = all_.join(again, ["kind", "value"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("more", F.lit(0)))
        all_ = draw(bumped, "surrogates")
    raise RuntimeError(f"no distinct surrogates after {ROUNDS} draws")


def _replaced(key: bytes):
    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text, redrawn) -> (doc_id, text, n_entities, kinds, spans)."""
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for b in batches:
            texts, ns, kinds, spans = [], [], [], []
            for text, again in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                attempts = {(a["kind"], a["value"]): a["attempt"] for a in again or ()}
                new, k, s = replace(text, key, attempts) if text else (text, {}, [])
                texts.append(new)
                ns.append(sum(k.values()))
                kinds.append(",".join(f"{x}:{k[x]}" for x in sorted(k)))
                spans.append([{"start": x, "end": y, "kind": z} for x, y, z in s])
            cols = [b.column(0), pa.array(texts, pa.string()), pa.array(ns, pa.int64()), pa.array(kinds, pa.string()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text", "n_entities", "kinds", "spans"])

    return replaced


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text with surrogates, n_entities, kinds (kind:count list), spans of the surrogates."""
    secret = blake2b(key.encode(), digest_size=32).digest()
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    found = stage(rows.mapInArrow(_found, f"doc_id {id_type}, text_hash long, kind string, value string"), "entities")
    again = stage(redrawn(found.select("kind", "value").distinct(), secret), "redrawn")
    out = f"doc_id {id_type}, text string, n_entities long, kinds string, spans array<struct<start:int,end:int,kind:string>>"
    if again.isEmpty():
        plain = rows.select("doc_id", "text", F.lit(None).cast("array<struct<kind:string,value:string,attempt:int>>").alias("again"))
        return plain.mapInArrow(_replaced(secret), out)
    lists = found.distinct().join(again, ["kind", "value"]).groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"))
    lists = stage(lists.agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("again")), "redrawn-by-document")
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")), "left")
    return joined.select("doc_id", "text", "again").mapInArrow(_replaced(secret), out)
