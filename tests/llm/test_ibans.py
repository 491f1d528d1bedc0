"""IBANs end where their country's length says, whatever follows."""

import pytest

from costlake.llm import pii

DE, GB, NO, FR = "DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947", "FR1420041010050500013M02606"
SPACED = "DE89 3704 0044 0532 0130 00"


def marked(*parts):
    """The text of the parts and the spans of those given in a list."""
    text, spans = "", []
    for part in parts:
        if isinstance(part, list):
            spans.append(f"iban:{len(text)}:{len(text) + len(part[0])}")
            part = part[0]
        text += part
    return text, spans


CASES = [
    marked([DE], " The bank"),
    marked([SPACED], " Bitte"),
    marked("é😀 ", [SPACED], " BIC COBADEFFXXX"),
    marked([DE], " 5 items"),
    marked([SPACED], " 5 items"),
    marked([DE], " ", [GB]),
    marked([SPACED], " ", [GB], " ", [NO], " ", [FR], " ", [SPACED]),
    marked([NO], " ", [DE], ",", [FR], " X"),
    # a country and two digits before, whose code of the right length would reach into the IBAN
    marked("SE10 ", [SPACED]),
    marked("AT12 ", [SPACED], " The"),
    # too long, too short, wrong digits, no country
    marked(f"{DE}0 {DE[:-1]} DE89370400440532013001 x{DE}"),
    marked("QQ12 3704 0044 0532 0130 00"),
    marked("DE89 " * 5000),
    marked("A" * 50000, " ", [DE]),
]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "doc_id long, text string")
    reports = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("iban")] for r in pii.pii_report(docs).collect()}
    return reports, {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_ibans(rows, case):
    text, spans = CASES[case]
    assert rows[0][case] == spans
    for code in (SPACED, DE, GB, NO, FR):
        assert not spans or code not in rows[1][case]


def test_lengths_by_country():
    names = " ".join(pii.IBAN_COUNTRIES.values()).split()
    assert len(names) == len(set(names)) and all(len(n) == 2 for n in names)
