import re

from corpus_cases import no_documents, odd_documents, with_clashes
from demandgrid.llm import pii
from pyspark.sql import functions as F

KEY = b"test"
TEXT = ("Mail Anna.Bo@mail7.Example.com or +1 (017) 555-7713. Host 97.51.17.173, 10.1.2.3; card 4111 1111 1111 1111 or 9807915762804490. "
        "Mrs. Anna Schmidt met Frau Schmidt. GB82 WEST 1234 5698 7654 32, 078-05-1120. Ольга Петрова. Card 4111-1111-1111-1111.")


def rewritten(text, key=KEY):
    return pii.rewrite(text, key, {}, {})[0]


def test_kinds_formats_and_coreference():
    new = rewritten(TEXT)
    assert new != TEXT and new == rewritten(TEXT) and new != rewritten(TEXT, b"other")
    for secret in ("Anna", "mail7", "555-7713", "97.51.17.173", "10.1.2.3", "4111", "9807915762804490", "Schmidt", "WEST", "078-05", "Петрова", "Ольга"):
        assert secret not in new
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.", new) and re.search(r"10\.\d+\.\d+\.\d+", new) and re.search(r"\d{3}-\d{2}-\d{4}\.", new)
    first = re.search(r"card ((?:\d{4} ){3}\d{4})", new)[1]
    assert pii.luhn(first.replace(" ", "")) and first.replace(" ", "-") in new
    name = re.search(r"Mrs\. (\w+) (\w+) met Frau (\w+)\.", new)
    assert name[1] in pii.FIRST_NAMES["latin", "f"] and name[2] == name[3] and len(name[2]) == len("Schmidt")
    assert re.search(r"[А-Я][а-я]+ [А-Я][а-я]{6}\.", new)
    iban = re.search(r"GB(\d\d) ([A-Z]{4}(?: \d{4}){3} \d\d)", new)
    assert iban[1] == pii.iban_check("GB", iban[2].replace(" ", ""))
    assert pii.detect(new) and [s[2].split()[0] for s in pii.detect(new)] == [s[2].split()[0] for s in pii.detect(TEXT)]


def test_common_forms_are_found():
    for text in ("+14155552671", "+491701234567", "4155552671", "+33 1 23 45 67 89", "01 23 45 67 89", "3782 822463 10005", "2001:db8::8a2e:370:7334",
                 "gb82 west 1234 5698 7654 32", "gb82west12345698765432", "John Smith", "Anna Weber"):
        new = rewritten(f"See {text}, then go.")
        kinds = [s[2].split()[0] for s in pii.detect(text)]
        assert kinds in (["phone"], ["card"], ["ipv6"], ["iban"], ["first", "last"])
        assert text not in new and not set(re.findall(r"\w{4,}", text)) & set(re.findall(r"\w{4,}", new)) - {"2001"}, (text, new)
    assert pii.detect("+491701234567")[0][3] == "1701234567"
    card = re.sub(r"\D", "", rewritten("3782 822463 10005"))
    assert len(card) == 15 and pii.luhn(card)
    assert [s[2].split()[0] for s in pii.detect("Dear John Smith")] == ["first", "last"]
    for text in ("at 12:30:45 or std::vector, add::face ::1", "1700000000 4.155552671"):
        assert rewritten(text) == text


def test_persons_of_one_surname_stay_apart():
    names = [n for kind in pii.FIRST_NAMES for n in pii.FIRST_NAMES[kind]]
    assert len(set(names)) == len(names)
    odd = ["Zebulon", "Quincy", "Wilhelmina", "Thorsten", "Leopold", "Ottokar"]
    new = [pii.surrogate(pii._first(n), n.lower(), 0, KEY) for n in names + odd]
    assert len(set(new)) == len(new)


def test_surrogates_are_permutations():
    assert len({pii.surrogate("phone", f"{i:04d}", 0, KEY) for i in range(10_000)}) == 10_000
    assert len({pii.surrogate("email", f"{a}{b}@x.org", 0, KEY) for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789"}) == 260
    valid = [f"4{i:05d}" for i in range(3000)]
    assert len({pii.surrogate("card", v, 0, KEY) for v in valid}) == 3000
    assert all(pii.luhn(pii.surrogate("card", v, 0, KEY)) == pii.luhn(v) for v in valid)


def test_clean_texts_stay():
    for text in ("Version 2.0 of 2024, page 12-13; 1,234.56 Mr. and Mrs. or Peter went home.", "a@b", "12 34", "", None):
        assert rewritten(text) == text


def test_collisions_take_another_surrogate(spark):
    # a surrogate that occurs as an entity itself must not be used
    value = "0175557713"
    taken = pii.surrogate("phone", value, 0, KEY)
    rows = [(1, "+1 (017) 555-7713"), (2, f"({taken[:3]}) {taken[3:6]}-{taken[6:]}"), (3, "(017) 555-7713 again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    odd = {(r["kind"], r["value"]): r["attempt"] for r in pii.exceptions(docs.select("text"), KEY).collect()}
    assert odd["phone", value] == 1
    new = {r["doc_id"]: re.sub(r"\D", "", r["text"].replace("+1", "")) for r in pii.pseudonymised(docs, KEY).collect()}
    assert new[1] == new[3] == pii.surrogate("phone", value, 1, KEY) and len(set(new.values())) == 2
    assert not set(new.values()) & {value, taken}


def test_odd_rows(spark):
    docs = odd_documents(spark).unionByName(spark.createDataFrame([(50, TEXT, "en", "a", len(TEXT)), (50, TEXT, "en", "a", None)], odd_documents(spark).schema))
    made = pii.stage(spark, with_clashes(docs), "")
    assert made.columns == with_clashes(docs).columns and made.count() == docs.count()
    old, new = ([r["text"] for r in d.filter("doc_id <> 50 or doc_id is null").orderBy("doc_id", "text").collect()] for d in (docs, made))
    assert old == new
    twice = made.filter("doc_id = 50").collect()
    assert twice[0]["text"] == twice[1]["text"] != TEXT and {r["n_chars"] for r in twice} == {None, len(twice[0]["text"])}
    assert pii.pseudonymised(no_documents(spark)).count() == 0
    counted = pii.pseudonymised(docs.select("doc_id", "text")).filter(F.col("doc_id") == 50).first()
    assert counted["n_entities"] == len(counted["entities"].split(",")) == len(pii.detect(TEXT))
