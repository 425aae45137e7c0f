"""Personal data replaced by keyed surrogates of the same type, script, gender and format.

Detected: e-mail addresses, IPv4 and IPv6 addresses, payment card numbers (also as 4-6-5 digits), phone numbers (with
separators, as "+" and 8 to 15 digits, in pairs, or as ten digits that form a North American number), social security
numbers, IBANs in either case, and names of persons (after a title, or a listed first name before a capitalised word).

Every surrogate is a keyed permutation of the set of strings with the same format (a Feistel network over the
positions, each with its own alphabet: digits, letters of the script, vowels and consonants in surnames), so

* equal entities get equal surrogates in every document (coreference), also when written with other punctuation or case;
* different entities get different surrogates;
* check digits stay valid if they were (cards, IBANs), private addresses stay private, a listed first name becomes
  one of the same gender and script, top-level domains, country codes and punctuation stay.

Collision check: all distinct entities of the corpus form a table; a surrogate that equals an entity that occurs, or the
surrogate of another entity, is replaced by that of the next permutation until none is left. Such exceptions are few;
they are joined to the documents by content, nothing is collected. Where a short format is so crowded that this does not
end within ``ATTEMPTS`` rounds, all its entities take the first permutation, which keeps them distinct from each other.
Persons are told apart as a whole: listed first names are permuted among the names of their list, others among the strings
that are no listed name, and surnames take part in the check (as first names do that are not listed), so two persons never
get equal surrogates, nor one that occurs.

Defined results: NULL and empty texts stay as they are and have no entity; texts of any length are read whole; repeated
rows are all rewritten alike; ``doc_id`` is not used. ``n_chars``, where present and not NULL, becomes the new length.
Other columns pass through; helper columns begin with an underscore.
"""

from __future__ import annotations

import contextlib
import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from demandgrid.llm.common import content_key, held, table

KEY = b"replace this key"
ROUNDS = 8
ATTEMPTS = 8
MEMORY = 50_000

# First names by script and gender, titles by gender, ranges of letters.
FIRST_NAMES = {
    ("latin", "f"): "Alice Barbara Carla Diana Emily Florence Greta Hannah Isabel Julia Katharina Laura Maria Nicole Olivia Paula Rebecca Sarah Teresa Victoria".split(),
    ("latin", "m"): "Albert Benjamin Carlos David Edward Frank George Henry Ivan James Kevin Louis Michael Nicholas Oliver Peter Robert Stefan Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Максим Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Αθηνά Βασιλική Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Αντώνης Βασίλης Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Παύλος".split(),
}
MORE_NAMES = {
    ("latin", "f"): """Abigail Ada Adele Agnes Alexandra Alexis Alicia Amanda Amelia Amy Ana Andrea Angela Anita Ann Anna Anne Annie
        Ashley Audrey Ava Beatrice Bernadette Bertha Beth Betty Bianca Brenda Bridget Camille Carmen Carol Caroline Catherine Cecilia
        Charlotte Chloe Christina Christine Claire Clara Claudia Colette Cynthia Daniela Deborah Denise Donna Doris Dorothy Edith Eleanor
        Elena Elisabeth Elizabeth Ella Ellen Emma Erika Esther Eva Evelyn Fatima Franziska Gabriela Gabriele Gisela Gloria Grace Hanna
        Heather Heidi Helen Helena Ida Inge Ingrid Irene Isabella Jacqueline Jane Janet Jennifer Jessica Joan Joanna Josephine Judith Judy
        Juliet Karen Karin Kate Katherine Kathleen Katie Kelly Kimberly Lena Leonie Lillian Linda Lisa Lucia Lucy Lydia Manon Margaret
        Margarita Marie Marion Martha Martina Mary Megan Melanie Melissa Mia Michelle Monica Monika Nadia Nancy Natalie Nina Nora Pamela
        Patricia Petra Pilar Rachel Renate Rita Rosa Rose Ruth Sabine Samantha Sandra Sara Sharon Silvia Simone Sofia Sophia Sophie
        Stefanie Stephanie Susan Susanne Sylvia Tanja Theresa Ursula Valentina Valerie Vanessa Vera Veronica Virginia Yvonne Zoe""".split(),
    ("latin", "m"): """Aaron Adam Adrian Alan Alejandro Alexander Alfred Andreas Andrew Anthony Antoine Anton Antonio Arthur Bernard Bernd
        Bill Bob Brandon Brian Bruno Charles Christian Christopher Claude Daniel Dennis Diego Dieter Dirk Donald Douglas Eduardo Emil Eric
        Erik Ernst Ethan Felix Fernando Florian Francis Francisco Franz François Friedrich Gabriel Gary Gerald Gerhard Gilbert Gregory
        Günther Gustav Hans Harald Harold Harry Heinz Helmut Henri Herbert Hugo Ian Jack Jacob Jan Jason Javier Jean Jeffrey Jens Jeremy
        Jerry Joachim Joe Joel Johann Johannes John Jonas Jonathan Jorge Jose José Josef Joseph Joshua Juan Julian Jürgen Justin Karl
        Keith Kenneth Klaus Konrad Kurt Larry Lars Laurent Lawrence Leo Leon Leonard Luca Lucas Luis Lukas Manuel Marc Marcel Marco Mario
        Mark Markus Martin Matthew Matthias Max Maximilian Michel Miguel Mohamed Muhammad Nathan Nick Nicolas Noah Olaf Otto Pablo Pascal
        Patrick Paul Pedro Philip Philipp Philippe Pierre Rainer Ralf Ralph Raymond Richard Roger Roland Roman Ronald Rudolf Russell Ryan
        Samuel Scott Sean Sebastian Sergio Simon Stephen Steve Steven Sven Theodor Tim Timothy Tobias Tom Tyler Uwe Victor Vincent Walter
        Werner Wilhelm Wolfgang Xavier Zachary""".split(),
    ("cyrillic", "f"): "Александра Алина Алла Анастасия Валентина Валерия Вероника Виктория Галина Екатерина Евгения Елизавета Жанна Зоя Инна Кристина Ксения Лариса Лидия Любовь Людмила Марина Надежда Нина Полина Раиса Софья Тамара Юлия Яна".split(),
    ("cyrillic", "m"): "Александр Анатолий Андрей Антон Артём Вадим Валерий Василий Владимир Владислав Вячеслав Геннадий Георгий Григорий Даниил Денис Евгений Егор Игорь Илья Кирилл Константин Лев Леонид Михаил Никита Пётр Роман Руслан Семён Степан Фёдор Юрий Ярослав".split(),
    ("greek", "f"): "Αγγελική Αικατερίνη Αλεξάνδρα Αναστασία Άννα Γεωργία Δέσποινα Δήμητρα Ειρήνη Ευαγγελία Ζωή Καλλιόπη Κωνσταντίνα Παναγιώτα Παρασκευή".split(),
    ("greek", "m"): "Αθανάσιος Αλέξανδρος Ανδρέας Απόστολος Γεώργιος Δημήτριος Ευάγγελος Θανάσης Θεόδωρος Ιωάννης Γιάννης Κωνσταντίνος Νικόλαος Παναγιώτης Σπύρος Σταύρος Χρήστος".split(),
}
FIRST_NAMES = {kind: list(dict.fromkeys(names + MORE_NAMES[kind])) for kind, names in FIRST_NAMES.items()}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mademoiselle Señora Госпожа Κυρία".split(),
          "m": "Mr Herr Monsieur Señor Господин Κύριος".split()}
LETTERS = ("az", "àö", "øÿ", "ая", "άώ", "09")
VOWELS = "aeiouy"

UPPER = "A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩА-ЯЁ"
EMAIL = re.compile(r"[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}")
DIGIT = re.compile("[0-9]")
NUMBER = re.compile(
    r"(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]|\w))"
    r"|(?P<ipv6>(?<![\w:.])(?=[0-9A-Fa-f:]{2,39}(?![\w:]))(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
    r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:]))"
    r"|(?P<amex>(?<!\w)3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}(?!\w))"
    r"|(?P<card>(?<!\w)[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\w]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<e164>(?<![\w+])\+[0-9]{8,15}(?!\w))"
    r"|(?P<pairs>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?(?:\(0\))?[1-9]|0[1-9])(?:[ .-][0-9]{2}){4}(?![\w]|[ .-][0-9]))"
    r"|(?P<ten>(?<![\w.,+-])(?:1[ .-]?)?[2-9][0-9]{2}[2-9][0-9]{6}(?![\w]|[.,][0-9]))"
    r"|(?P<phone>(?<!\w)(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<lower>(?<!\w)[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?(?!\w))")
TITLED = re.compile(rf"\b({'|'.join(t for ts in TITLES.values() for t in ts)})\.?[ ]+([{UPPER}][\w'’-]+)(?:[ ]+([{UPPER}][\w'’-]+))?")
PAIR = re.compile(rf"(?<!\w)([{UPPER}][\w]+)(?=[ ]+([{UPPER}][\w'’-]+))")
KNOWN = {name.lower(): kind for kind, names in FIRST_NAMES.items() for name in names}
# lengths of IBANs; lower-case ones must have that of their country
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20
    EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20
    LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28
    TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()}
# calling codes of two digits, and of one; all others have three
TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

Span = tuple[int, int, str, str]   # start, end, kind, canonical form


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _first(word: str) -> str:
    known = KNOWN.get(word.lower())
    return f"first {known[0]} {known[1]}" if known else "first"


def detect(text: str | None) -> list[Span]:
    """Entities by position; of overlapping ones the first, then the longest."""
    if not text:
        return []
    found: list[Span] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            kind, value = m.lastgroup, m[0]
            if kind == "ip":
                if all(int(x) < 256 for x in value.split(".")):
                    found.append((m.start(), m.end(), "ip", ".".join(str(int(x)) for x in value.split("."))))
            elif kind == "ipv6":
                if len(value) > 3 and DIGIT.search(value):   # neither a loop back nor two words
                    with contextlib.suppress(ValueError):
                        found.append((m.start(), m.end(), kind, ipaddress.IPv6Address(value).exploded.replace(":", "")))
            elif kind == "e164":
                width = 1 + (1 if value[1] in "17" else 2 if value[1:3] in TWO_DIGITS else 3)
                found.append((m.start() + width, m.end(), "phone", value[width:]))
            elif kind == "ten":
                number = digits(value)[-10:]
                found.append((m.end() - 10, m.end(), "phone", number))
            elif kind == "amex":
                found.append((m.start(), m.end(), "card", digits(value)))
            elif kind == "lower":
                # words that follow may be in the match
                while value and not iban_valid(value.replace(" ", "").upper()):
                    value = value.rpartition(" ")[0]
                if value:
                    found.append((m.start(), m.start() + len(value), "iban", value.replace(" ", "").upper()))
            elif kind in ("phone", "pairs"):
                code = re.match(r"\+[0-9]{1,3}(?![0-9])", value)
                found.append((m.start() + (code.end() if code else 0), m.end(), "phone", digits(value[code.end() if code else 0:])))
            elif kind == "iban":
                found.append((m.start(), m.end(), "iban", value.replace(" ", "")))
            else:
                found.append((m.start(), m.end(), kind, digits(value)))
    for m in TITLED.finditer(text):
        words = [(m.start(i), m.end(i), m[i]) for i in (2, 3) if m[i]]
        for at, (a, b, word) in enumerate(words):
            last = at == len(words) - 1
            found.append((a, b, "last" if last else _first(word), word.lower()))
    for m in PAIR.finditer(text):
        if m[1].lower() in KNOWN:
            found += [(m.start(1), m.end(1), _first(m[1]), m[1].lower()), (m.start(2), m.end(2), "last", m[2].lower())]
    kept: list[Span] = []
    for span in sorted(found, key=lambda s: (s[0], -s[1], s[2])):
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    return kept


def _noise(key: bytes, tweak: str, turn: int, value: int) -> int:
    data = f"{tweak}|{turn}|{value}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "big")


def permuted(values: list[int], sizes: list[int], key: bytes, tweak: str) -> list[int]:
    """Keyed permutation of all value lists with the given sizes of alphabets."""
    if not values:
        return []
    if len(values) == 1:
        order = sorted(range(sizes[0]), key=lambda i: _noise(key, tweak, -1, i))
        return [order[values[0]]]
    half = len(values) // 2
    parts, radix = [values[:half], values[half:]], [sizes[:half], sizes[half:]]
    numbers, limits = [0, 0], [1, 1]
    for side in (0, 1):
        for v, s in zip(parts[side], radix[side]):
            numbers[side], limits[side] = numbers[side] * s + v, limits[side] * s
    for turn in range(ROUNDS):
        side = turn % 2
        numbers[side] = (numbers[side] + _noise(key, tweak, turn, numbers[1 - side])) % limits[side]
    out: list[int] = []
    for side in (0, 1):
        rest, number = [], numbers[side]
        for s in reversed(radix[side]):
            number, v = divmod(number, s)
            rest.append(v)
        out += reversed(rest)
    return out


def _alphabet(c: str, name: bool) -> str:
    if name and "a" <= c <= "z":
        return VOWELS if c in VOWELS else "".join(x for x in map(chr, range(97, 123)) if x not in VOWELS)
    for low, high in LETTERS:
        if low <= c <= high:
            return "".join(x for x in map(chr, range(ord(low), ord(high) + 1)) if x.isalnum())
    return c


def letters_permuted(text: str, key: bytes, tweak: str, name: bool = False) -> str:
    """Lower-case text with each character replaced inside its alphabet; other characters stay."""
    alphabets = [_alphabet(c, name) for c in text]
    free = [i for i, a in enumerate(alphabets) if len(a) > 1]
    pattern = "".join(a[0] for a in alphabets)
    new = permuted([alphabets[i].index(text[i]) for i in free], [len(alphabets[i]) for i in free], key, f"{tweak}|{pattern}")
    out = list(text)
    for i, v in zip(free, new):
        out[i] = alphabets[i][v]
    return "".join(out)


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_check(country: str, account: str) -> str:
    value = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(value) % 97:02d}"


def iban_valid(value: str) -> bool:
    return len(value) == IBAN_LENGTHS.get(value[:2]) and iban_check(value[:2], value[4:]) == value[2:4]


def _octets(text: str) -> tuple[list[int], int]:
    """Octets and how many leading ones tell that the address is not public."""
    o = [int(x) for x in text.split(".")]
    if o[0] in (10, 127):
        return o, 1
    return o, 2 if (o[0], o[1]) == (192, 168) or o[0] == 172 and 16 <= o[1] < 32 else 0


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """Canonical form that stands for a canonical form."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, _, domain = value.partition("@")
        labels, _, top = domain.rpartition(".")
        return letters_permuted(f"{local}@{labels}", key, tweak) + f".{top}"
    if kind == "ip":
        octets, fixed = _octets(value)
        while True:
            octets = octets[:fixed] + permuted(octets[fixed:], [256] * (4 - fixed), key, f"{tweak}|{octets[:fixed]}")
            text = ".".join(map(str, octets))
            if fixed or (_octets(text)[1] == 0 and 1 <= octets[0] <= 223) or not 1 <= int(value.split(".")[0]) <= 223:
                return text
    if kind == "card":
        valid, text = luhn(value), value
        while True:
            text = text[0] + letters_permuted(text[1:], key, f"{tweak}|{text[0]}")
            if luhn(text) == valid:
                return text
    if kind == "ipv6":
        # the first group tells the kind of address and stays
        return value[:4] + "".join(f"{v:x}" for v in permuted([int(c, 16) for c in value[4:]], [16] * 28, key, f"{tweak}|{value[:4]}"))
    if kind in ("phone", "ssn"):
        return letters_permuted(value, key, tweak)
    if kind == "iban":
        country, check, account = value[:2], value[2:4], value[4:]
        new = letters_permuted(account.lower(), key, f"{tweak}|{country}").upper()
        return country + (iban_check(country, new) if check == iban_check(country, account) else check) + new
    if kind.startswith("first "):
        _, script, gender = kind.split()
        names = [n.lower() for n in FIRST_NAMES[script, gender]]
        return names[permuted([names.index(value)], [len(names)], key, tweak)[0]]
    if kind == "first":
        text = letters_permuted(value, key, tweak, name=True)
        while text in KNOWN:
            text = letters_permuted(text, key, tweak, name=True)
        return text
    return letters_permuted(value, key, tweak, name=True)


def rendered(kind: str, original: str, new: str) -> str:
    """``new`` with the punctuation and case of ``original``."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(new)
        return "".join((n.lower() if c.islower() else n) if c.isalnum() and (n := next(rest)) else c for c in original)
    if kind == "ip":
        return new
    if kind == "ipv6":
        text = ipaddress.IPv6Address(int(new, 16)).compressed
        return text.upper() if any(c.isupper() for c in original) else text
    if len(new) == len(original):
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new))
    return new.upper() if original.isupper() else new.capitalize() if original[:1].isupper() else new


def rewrite(text: str | None, key: bytes, attempts: dict[tuple[str, str], int], seen: dict) -> tuple[str | None, int, str]:
    """Text with surrogates, number of entities, and their kinds and places in the old text. ``seen`` holds surrogates."""
    spans = detect(text)
    if not spans:
        return text, 0, ""
    out, at = [], 0
    for start, end, kind, value in spans:
        wanted = kind, value, attempts.get((kind, value), 0)
        new = seen.get(wanted)
        if new is None:
            if len(seen) > MEMORY:
                seen.clear()
            new = seen[wanted] = surrogate(*wanted, key)
        out += [text[at:start], rendered(kind, text[start:end], new)]
        at = end
    told = ",".join(f"{kind.split()[0]}:{a}:{b}" for a, b, kind, _ in spans)
    return "".join([*out, text[at:]]), len(spans), told


@F.pandas_udf(T.ArrayType(T.StructType().add("kind", "string").add("value", "string")))
def entities(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "value": v} for _, _, k, v in detect(t)] for t in texts], dtype=object)


def _surrogates(key: bytes):
    @F.pandas_udf("string")
    def made(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, v, a, key) for k, v, a in zip(kind, value, attempt)], dtype=object)

    return made


def exceptions(docs: DataFrame, key: bytes) -> DataFrame | None:
    """Entities (kind, value, attempt) whose first surrogate collides, with the attempt that does not."""
    known = held(docs.select(F.explode(entities("text")).alias("e")).select("e.kind", "e.value")
                 .filter(~F.col("kind").startswith("first ")).distinct(), "entities")
    made = _surrogates(key)
    state = held(known.withColumn("attempt", F.lit(0)).withColumn("new", made("kind", "value", F.lit(0))), "surrogates")
    for _ in range(ATTEMPTS):
        shared = state.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min("value").alias("owner")).filter("n > 1").drop("n")
        present = known.select("kind", F.col("value").alias("new"), F.lit(True).alias("present"))
        clash = (state.join(shared, ["kind", "new"], "left").join(present, ["kind", "new"], "left")
                 .filter(F.col("present") | (F.col("owner") != F.col("value"))).select("kind", "value", F.lit(1).alias("more")))
        clash = held(clash, "clashes")
        if clash.isEmpty():
            return None if state.filter("attempt > 0").isEmpty() else state.filter("attempt > 0").select("kind", "value", "attempt")
        state = held(state.join(clash, ["kind", "value"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("more", F.lit(0)))
                     .withColumn("new", F.when(F.col("more").isNull(), F.col("new")).otherwise(made("kind", "value", "attempt")))
                     .select("kind", "value", "attempt", "new"), "surrogates")
    # a format of which nearly all strings occur: one permutation for all of it keeps its surrogates distinct
    group = F.struct("kind", F.when(F.col("kind") == "ip", 0).otherwise(F.length("value")))
    full = clash.select(group.alias("group")).distinct()
    odd = state.filter("attempt > 0").withColumn("group", group).join(full, "group", "left_anti")
    return None if odd.isEmpty() else odd.select("kind", "value", "attempt")


def pseudonymised(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with ``text`` rewritten, ``n_entities`` and ``entities`` ("kind:start:end" in the old text)."""
    odd = exceptions(docs.select("text"), key)
    fields = "text string, n_entities int, entities string"
    if odd is None:
        @F.pandas_udf(fields)
        def plain(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            seen: dict = {}
            for texts in batches:
                yield pd.DataFrame([rewrite(t, key, {}, seen) for t in texts], columns=["text", "n_entities", "entities"])

        rewritten = docs.withColumn("_new", plain("text"))
    else:
        @F.pandas_udf(fields)
        def mapped(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            seen: dict = {}
            for texts, extra in batches:
                maps = [{(e["kind"], e["value"]): e["attempt"] for e in (x if x is not None else ())} for x in extra]
                yield pd.DataFrame([rewrite(t, key, m, seen) for t, m in zip(texts, maps)], columns=["text", "n_entities", "entities"])

        per_text = (docs.select(content_key(F.col("text")).alias("_key"), F.explode(entities("text")).alias("e"))
                    .select("_key", "e.kind", "e.value").distinct().join(odd, ["kind", "value"])
                    .groupBy("_key").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("_odd")))
        keyed = docs.withColumn("_key", content_key(F.col("text"))).join(held(per_text, "exceptions"), "_key", "left").drop("_key")
        rewritten = keyed.withColumn("_new", mapped("text", "_odd")).drop("_odd")
    return _unpacked(rewritten, docs.columns)


def _unpacked(rewritten: DataFrame, columns: list[str]) -> DataFrame:
    def kept(name: str) -> Column:
        if name == "n_chars":
            return F.when(F.col("n_chars").isNotNull(), F.length("_new.text").cast(rewritten.schema["n_chars"].dataType)).alias("n_chars")
        return F.col("_new.text").alias("text") if name == "text" else F.col(name)

    extra = [F.col(f"_new.{n}").alias(n) for n in ("n_entities", "entities") if n not in columns]
    return rewritten.select(*map(kept, columns), *extra)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonymised(docs).select(*docs.columns)
