"""Personal data replaced by keyed surrogates of the same kind and form.

Entities are found by pattern: e-mail addresses, telephone numbers, account numbers (13 to 19 digits), US social security numbers,
IPv4 addresses, named secrets, and titled names. The same entity gets the same surrogate in every document (coreference), whatever its
spelling's case or punctuation, and different entities of a form get different ones: a surrogate is a keyed permutation of all
values of the entity's form (an alternating Feistel network over the digits' and letters' own radices), so digits stay digits, vowels
vowels, letters of a script letters of that script, case and punctuation stay, addresses stay addresses, and numbers that satisfy the
Luhn check (or don't) go on doing so. Given names change within the list of their gender and script, never to themselves. Letters of scripts
without a list of their own change among the letters of their script that stand near them in Unicode.

Collision check: no surrogate may be an entity that the corpus really holds, nor serve two. The corpus's entities are a table; those whose
surrogate fails the check try the next permutation until none fails. An entity that no permutation moves, or that finds none free in TRIES
attempts because its form is small and much used, gets a longer surrogate: a permutation with keyed letters or digits added. Such entities are
rare; where there are any, the documents that hold them are told which attempt to take by a join. One exception: a listed given name that stands
alone may change to one that the corpus holds too, because the lists are short; it never stays and is never shared.

Defined results: null and empty texts stay and have no entities. Null and repeated doc_ids are carried along.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed

#: Titles by gender, and given names by gender and script.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"), "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")}
GIVEN = {
    ("f", "latin"): ("anna", "maria", "laura", "sofia", "emma", "julia", "clara", "elena", "marta", "alice", "nina", "carla", "sara", "lucia", "irene", "eva"),
    ("m", "latin"): ("john", "peter", "paul", "mark", "david", "thomas", "martin", "daniel", "simon", "oscar", "felix", "hugo", "leo", "victor", "karl", "max"),
    ("f", "cyrillic"): ("анна", "мария", "елена", "ольга", "ирина", "нина", "вера", "софия"),
    ("m", "cyrillic"): ("иван", "пётр", "павел", "борис", "олег", "игорь", "антон", "юрий"),
}
#: Letters that change among themselves.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "çñß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ")
HEX = "0123456789abcdef"

_TITLE = "|".join(sorted((t for names in TITLES.values() for t in names), key=len, reverse=True))
_NAME = r"[^\W\d_a-zß-öø-ÿа-яё][^\W\d_]+"
PATTERN = re.compile(
    "|".join(
        (
            r"(?P<email>(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})",
            r"(?P<secret>(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\W{0,6}[:=]\W{0,6})(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{12,})",
            r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))",
            r"(?P<account>(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w]|\.\d))",
            r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?P<phone>(?:(?<![\w+])\+\d{1,3}[^\w\n(+]{1,6})?\(\d{2,4}\)[^\w\n(+]{0,6}\d{3,4}[ .-]\d{3,4}(?!\d)|(?<![\w+.])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-]*\d))",
            rf"(?P<person>(?<!\w)(?:{_TITLE})\.?[ ]{_NAME}(?:[ -]{_NAME}){{0,2}})",
        )
    )
)
KINDS = tuple(PATTERN.groupindex)
#: Any entity holds one of these; texts without them are passed by.
HINTS = (*"@=:0123456789", *sorted({title for names in TITLES.values() for title in names}))
_SECRET_HEAD = re.compile(r"(?s)^(.*[:=]\W{0,6})([A-Za-z0-9+/_-]{12,})$")
_PERSON = re.compile(rf"^((?:{_TITLE})\.?)[ ](.*)$")
ROUNDS = 8
#: Permutations tried before a longer surrogate.
TRIES = 8


def permuted(values: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed permutation of all digit lists with these radices."""
    if not values:
        return values
    half = (len(values) + 1) // 2
    parts, sizes = [values[:half], values[half:]], [radices[:half], radices[half:]]
    for r in range(ROUNDS):
        i = r % 2
        salt = hashlib.blake2b(f"{tweak}|{r}|{radices}|{parts[1 - i]}".encode(), key=key, digest_size=32).digest()
        carry = int.from_bytes(salt, "big")
        out = []
        for v, size in zip(parts[i], sizes[i], strict=True):  # adds a mixed-radix number, modulo the number of lists
            carry += v
            out.append(carry % size)
            carry //= size
        parts[i] = out
    return parts[0] + parts[1]


def folded(text: str) -> str:
    """text in small letters, character by character, so that its length stays; both small sigmas are one."""
    return "".join("σ" if c == "ς" else low if len(low := c.lower()) == 1 else c for c in text)


@lru_cache(maxsize=1 << 16)
def _class_of(c: str, classes: tuple[str, ...] = CLASSES) -> str | None:
    """The characters that c, in small form, changes among. With CLASSES also those of other scripts: the letters of the script beside it."""
    found = next((s for s in classes if c in s), None)
    if found or classes is not CLASSES or not c.isalpha():
        return found
    script = lambda x: unicodedata.name(x, " ").split(" ")[0]
    if script(c) in ("", "LATIN", "CYRILLIC"):
        return None
    first, kind = ord(c) & ~0xFF, unicodedata.category(c)
    near = "".join(x for x in map(chr, range(first, first + 256)) if unicodedata.category(x) == kind and script(x) == script(c) and folded(x) == folded(x.upper()) == x)
    return near if c in near and len(near) > 1 else None


def _letters(text: str, key: bytes, tweak: str, classes: tuple[str, ...] = CLASSES) -> str:
    """text with its letters and digits permuted within their classes; case and all else stay."""
    at, sets = [], []
    for k, c in enumerate(text):
        found = _class_of(folded(c), classes)
        if found:
            at.append(k)
            sets.append(found)
    shape = "".join("x" if k in set(at) else c for k, c in enumerate(text))
    new = permuted([s.index(folded(text[k])) for k, s in zip(at, sets, strict=True)], [len(s) for s in sets], key, f"{tweak}|{shape}")
    out = list(text)
    for k, s, v in zip(at, sets, new, strict=True):
        out[k] = s[v].upper() if text[k].isupper() and s[v].upper().lower() == s[v] and len(s[v].upper()) == 1 else s[v]
    return "".join(out)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _number(digits: str, key: bytes, tweak: str) -> str:
    return "".join(map(str, permuted([int(d) for d in digits], [10] * len(digits), key, tweak)))


def canonical(kind: str, found: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("phone", "account", "ssn"):
        return re.sub(r"\D", "", found)
    if kind == "secret":
        return _SECRET_HEAD.match(found)[2]
    if kind == "ip":
        return ".".join(str(int(x)) for x in found.split("."))
    if kind == "person":
        title, name = _PERSON.match(found).groups()
        gender = next(g for g, names in TITLES.items() if title.rstrip(".") in names)
        return f"{gender}:{folded(name)}"
    return folded(found)


def permute(kind: str, value: str, key: bytes) -> str:
    """The key's permutation of a kind's canonical values."""
    if kind == "phone":
        head, tail = value[:-10], value[-10:]
        return head + _number(tail, key, "phone")
    if kind == "account":
        new = _number(value, key, "account")
        while luhn(new) != luhn(value):
            new = _number(new, key, "account")
        return new
    if kind == "ssn":
        return _number(value, key, "ssn")
    if kind == "ip":
        return ".".join(map(str, permuted([int(x) for x in value.split(".")], [256] * 4, key, "ip")))
    if kind == "secret":
        lower = value.lower()
        classes = (HEX,) if all(c in HEX for c in lower) and value in (lower, value.upper()) else ("0123456789", "abcdefghijklmnopqrstuvwxyz")
        return _letters(value, key, "secret", classes) if len(classes) == 1 else _cased(value, key)
    if kind == "email":
        host, _, top = value.rpartition(".")
        return f"{_letters(host, key, 'email|' + top)}.{top}"
    gender, _, name = value.partition(":")
    first, gap, rest = re.match(r"([^ -]+)([ -]?)(.*)", name).groups()
    script = "cyrillic" if re.search("[а-яё]", first) else "latin"
    known = GIVEN[gender, script]
    everyone = {n for names in GIVEN.values() for n in names}
    if first in known:
        at = known.index(first)
        new_at = permuted([at], [len(known)], key, f"{gender}|{script}")[0]
        if new_at == at:  # the key turns the list by nothing, and so leaves every name of it
            new_at = (at + 1 + permuted([0], [len(known) - 1], key, f"{gender}|{script}|turn")[0]) % len(known)
        new = known[new_at]
    else:
        new = _letters(first, key, "name")
        while new in everyone and first not in everyone:
            new = _letters(new, key, "name")
    return f"{gender}:{new}{gap}{_letters(rest, key, 'surname')}"


def longer(kind: str, value: str, key: bytes) -> str:
    """A permutation of value with 14 keyed letters or 20 keyed digits more, for forms that can't move or are used up."""
    new = permute(kind, value, key)
    salt = int.from_bytes(hashlib.blake2b(f"longer|{kind}|{value}".encode(), key=key, digest_size=32).digest(), "big")
    if kind == "ip":
        return ".".join([new, *(str(salt >> 8 * k & 255) for k in range(8))])
    letters, size = ("0123456789", 20) if kind not in ("person", "email") else ("abcdefghijklmnopqrstuvwxyz", 14)
    if kind == "person":
        letters = _class_of(new[-1]) or letters
    more = "".join(letters[salt // len(letters) ** k % len(letters)] for k in range(size))
    name, sign, host = new.rpartition("@") if kind == "email" else (new, "", "")
    return name + more + sign + host


def _cased(value: str, key: bytes) -> str:
    """A secret's characters permuted among digits, small and capital letters, case being part of the value."""
    sets = ["0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in value if c.isalnum()]
    chars = [c for c in value if c.isalnum()]
    new = iter(permuted([s.index(c) for s, c in zip(sets, chars, strict=True)], [len(s) for s in sets], key, "secret|" + re.sub(r"\w", "x", value)))
    sets_left = iter(sets)
    return "".join(next(sets_left)[next(new)] if c.isalnum() else c for c in value)


def _digits_into(found: str, digits: str) -> str:
    rest = iter(digits)
    return "".join([*(next(rest) if c.isdigit() else c for c in found), *rest])


def rendered(kind: str, found: str, surrogate: str) -> str:
    """The surrogate in the mention's own form."""
    if kind in ("phone", "account", "ssn"):
        return _digits_into(found, surrogate)
    if kind == "secret":
        return _SECRET_HEAD.match(found)[1] + surrogate
    if kind == "ip":
        return surrogate
    if kind == "person":
        title, name = _PERSON.match(found).groups()
        new = surrogate.partition(":")[2]
        words, old = re.split(r"([ -])", new), re.split(r"([ -])", name)
        return f"{title} " + "".join(n.upper() if o.isupper() and len(o) > 1 else n.capitalize() for n, o in zip(words, old, strict=True))
    end = found.rindex("@")
    found = found[:end] + "x" * (len(surrogate) - len(found)) + found[end:]
    return "".join(n.upper() if o.isupper() and len(n.upper()) == 1 else n for n, o in zip(surrogate, found, strict=True))


def entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each entity, in order."""
    if not text or not any(hint in text for hint in HINTS):
        return []
    return [(m.lastgroup, m.start(), m.end()) for m in PATTERN.finditer(text)]


class Surrogates(dict):
    """(kind, canonical value, attempt) -> surrogate, remembering a bounded number. Each attempt is another permutation, those after TRIES a longer surrogate."""

    LIMIT = 100_000

    def __init__(self, key: bytes) -> None:
        self.key = key

    def __missing__(self, at: tuple[str, str, int]) -> str:
        kind, value, attempt = at
        key = self.key if attempt == 1 else hashlib.blake2b(str(attempt).encode(), key=self.key, digest_size=32).digest()
        new = permute(kind, value, key) if attempt <= TRIES else value
        if attempt > 1 and new == value:
            new = longer(kind, value, key)
        if len(self) < self.LIMIT:
            self[at] = new
        return new


def entity_table(docs: DataFrame) -> DataFrame:
    """The distinct entities of all texts: kind, value."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for x in batch.column(0):
                text = x.as_py()
                rows.update((kind, canonical(kind, text[a:b])) for kind, a, b in entities(text))
            kinds, values = zip(*sorted(rows), strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"])

    return docs.select("text").mapInArrow(found, "kind string, value string").distinct()


def attempts(real: DataFrame, key: bytes) -> DataFrame:
    """kind, value, attempt (above 1) for the entities whose first surrogate is themselves, another entity of real or already another's.

    Of entities with one surrogate the one with the lowest attempt and value keeps it, the others try the next permutation, and after TRIES of
    them longer surrogates, until no surrogate is shared or real. A listed given name alone may change to one that the corpus holds.
    """

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Surrogates(key)
        for batch in batches:
            new = [known[at] for at in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "value", "attempt", "new"])

    alone = [f"{gender}:{name}" for (gender, _), names in GIVEN.items() for name in names]
    taken = real.filter((F.col("kind") != "person") | ~F.col("value").isin(alone)).withColumnRenamed("value", "new")
    state = real.select("kind", "value", F.lit(1).alias("attempt"))
    while True:
        now = checkpointed(state.mapInArrow(tried, "kind string, value string, attempt int, new string"))
        met = now.join(taken, ["kind", "new"], "left_semi").unionByName(now.filter("new = value")).select("kind", "value")
        first = now.groupBy("kind", "new").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        shared = now.join(first, ["kind", "new"]).filter("value <> first.value").select("kind", "value")
        again = checkpointed(met.unionByName(shared).distinct().withColumn("again", F.lit(1)))
        if again.isEmpty():
            return now.filter("attempt > 1").select("kind", "value", "attempt")
        state = now.join(again, ["kind", "value"], "left").select("kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))


def replaced(docs: DataFrame, key: bytes, out: str = "text") -> DataFrame:
    """docs with ``__new`` (the text with surrogates), ``__kinds`` (the kind of each entity replaced) and ``__at`` (their places in the new text)."""
    real = checkpointed(entity_table(docs))
    retried = checkpointed(attempts(real, key))

    def swap(text: str | None, special: dict, known: Surrogates) -> tuple[str | None, list[str], list[int]]:
        parts, kinds, at, end, size = [], [], [], 0, 0
        for kind, a, b in entities(text):
            value = canonical(kind, text[a:b])
            new = rendered(kind, text[a:b], known[kind, value, special.get((kind, value), 1)])
            parts += [text[end:a], new]
            size += a - end
            at.append(size)
            kinds.append(kind)
            size, end = size + len(new), b
        return (text if not parts else "".join([*parts, text[end:]])), kinds, at

    schema = "__new string, __kinds array<string>, __at array<int>"
    with_attempts, columns = not retried.isEmpty(), docs.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Surrogates(key)
        for batch in batches:
            steps = batch.column(batch.schema.get_field_index("__attempts")).to_pylist() if with_attempts else [None] * batch.num_rows
            rows = []
            for x, s in zip(batch.column(batch.schema.get_field_index("text")), steps, strict=True):
                rows.append(swap(x.as_py(), {(e["kind"], e["value"]): e["attempt"] for e in s or ()}, known))
            new = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.list_(pa.string()), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), *new], names=[*columns, "__new", "__kinds", "__at"])

    rows = docs
    if with_attempts:
        def mentioned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(uid, kind, canonical(kind, t[a:b])) for uid, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for kind, a, b in entities(t)]
                of = [pa.array([f[k] for f in found], pa.string()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(of, names=["__mark", "kind", "value"])

        mark = F.sha2(F.coalesce("text", F.lit("")), 256)  # equal texts have equal entities
        mentions = docs.select(mark.alias("__mark"), "text").mapInArrow(mentioned, "__mark string, kind string, value string").distinct()
        of_text = mentions.join(retried, ["kind", "value"]).groupBy("__mark").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("__attempts"))
        rows = docs.join(of_text, mark == F.col("__mark"), "left").drop("__mark")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return rows.mapInArrow(each, f"{fields}, {schema}")


def surrogate_report(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, n_entities, and the kinds and places (in the new text) of the replacements."""
    rows = replaced(docs.select(F.col("doc_id").cast("long"), "text"), key)
    return rows.select("doc_id", F.col("__new").alias("text"), F.size("__kinds").cast("long").alias("n_entities"), F.concat_ws(",", "__kinds").alias("kinds"), F.concat_ws(",", F.transform("__at", lambda x: x.cast("string"))).alias("places"))


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with surrogates in text; n_chars, where there is one, follows in the texts that changed."""
    rows = replaced(docs, key).withColumn("text", F.col("__new"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("__kinds") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
