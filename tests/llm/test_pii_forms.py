"""Operator 8: one text per form that is found, and texts that stay."""

import unicodedata

import pytest

from gridloom.llm import pii

FOUND = {
    "call 415-555-0132 now": ["415-555-0132"],
    "call 415.555.0132, or 020 7946 0958.": ["415.555.0132", "020 7946 0958"],
    "host 2001:db8:85a3::8a2e:370:7334 and fe80:0:0:0:1:2:3:4 up": ["2001:db8:85a3::8a2e:370:7334", "fe80:0:0:0:1:2:3:4"],
    "seen by Dr. Smith and Prof Jones": ["Smith", "Jones"],
    "Herr Dr. Lehmann kam": ["Lehmann"],
    "ask Mr. Łukašžč Ğülşen today": ["Łukašžč", "Ğülşen"],
    "فوض السيد محمود اليوم": ["محمود"],
    "昨日は 田中さん と": ["田中"],
    "어제 김민수 씨 와": ["김민수"],
    "Mrs. Hartmann left. Later Hartmann wrote, and Hartmannsdorf stayed": ["Hartmann "],
}
KEPT = [
    "on 2024-01-15 at 12:30:45 by std::vector and add::be", "pages 100-200-3000", "ISBN 978-0-306-40615-7", "ratio 3:2 of 0.25",
    "Drive on, Professional Siren of Missouri", "the doctor said Smith would", "a Dr of letters",
]


@pytest.fixture(scope="module")
def replaced(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate([*FOUND, *KEPT])]
    df = spark.createDataFrame(rows, "doc_id long, text string, __h string, __by string, __between int")
    return {r.doc_id: r for r in pii.pseudonymised(df, "k").collect()}


def test_forms_are_replaced(replaced):
    for i, (text, parts) in enumerate(FOUND.items()):
        row = replaced[i]
        assert (row["__h"], row["__by"], row["__between"]) == ("x", "y", 1)
        assert row.n_replaced >= len([p for p in parts if " " not in p.strip()]) / 2 and len(row.text) == len(text), (text, row.text)
        assert all(p not in row.text for p in parts), (text, row.text)


def test_other_texts_stay(replaced):
    for i, text in enumerate(KEPT, len(FOUND)):
        assert (replaced[i].text, replaced[i].n_replaced) == (text, 0)


def test_a_name_without_its_title_is_the_same_person(replaced):
    words = replaced[len(FOUND) - 1].text.split()
    assert words[1] == words[4] != "Hartmann" and words[7] == "Hartmannsdorf"


def test_letters_stay_in_their_script(replaced):
    text = list(FOUND)[5]
    for old, new in zip(text, replaced[5].text):
        assert unicodedata.category(old) == unicodedata.category(new)
        assert unicodedata.name(old).split(" ")[0] == unicodedata.name(new).split(" ")[0]
    changed = [a != b for a, b in zip(text, replaced[5].text)]
    assert sum(changed[8:22]) >= 9, replaced[5].text
