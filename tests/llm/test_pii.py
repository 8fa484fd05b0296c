import hashlib
import re
import time

from meldstone.llm import pii

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain(text):
    """The base spans by searching whole texts with the four patterns."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", card),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"[^0-9]", "", s)) <= 15),
    }
    found = []
    for rank, (kind, (pattern, valid)) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(m[0]):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [label for _, _, label in sorted(found)]


def card(s):
    d = [int(c) for c in re.sub(r"[^0-9]", "", s)]
    if not 14 <= len(d) <= 19:
        return False
    even = sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
    return (sum(d[-1::-2]) + even) % 10 == 0


def random_text(rng):
    bits = ["a@b.co", "x.y+z@mail.example.com@q.r", "@", "@@a.b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (310) 555-4510", "+12", "+4", "é", "\U0001f600", "word", "\n", "\t", " ", "-", "..", "0005.1.1.1",
            "378282246310005", "30569309025904"]
    return "".join(rng.choice(bits) + rng.choice(["", " ", "\u00a0"]) for _ in range(rng.randrange(40)))


def test_base_spans_equal_plain_search(spark, rng):
    texts = [random_text(rng) for _ in range(300)] + [None, "", " ", "x" * 200_000 + " a@b.co"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    rows = {r["doc_id"]: r for r in pii.pii_report(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text)
        row = rows[i]
        assert [s for s in row["spans"].split(",") if s.split(":")[0] in pii.BASE_KINDS] == want
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s.startswith(k) for s in want) for k in pii.BASE_KINDS]


def test_added_kinds_need_checksum_or_context():
    labels = lambda t: [s.label().split(":")[0] for s in pii.find_spans(t)]
    assert "iban" in labels("IBAN DE89 3704 0044 0532 0130 00 here")
    assert "iban" not in labels("IBAN DE88 3704 0044 0532 0130 00 here")
    assert labels("ssn 123-45-6789") == ["ssn"] and labels("part 123-45-6789") == []
    assert labels('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"')[0] == "secret"


def test_context_moves_the_score():
    score = lambda t: pii.find_spans(t)[0].score
    assert score("call +1 (310) 555-4510") > score("see +1 (310) 555-4510") > score("isbn +1 (310) 555-4510")


def test_redaction_keeps_columns_and_other_rows(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.co now", "en", "s", 15, "x"), (None, None, None, None, None, None), (2, "", "en", "s", 0, "y")],
        SCHEMA + ", pii_note string",
    )
    rows = pii.redact(docs).collect()
    assert pii.redact(docs).columns == docs.columns
    assert sorted(rows, key=str) == sorted(
        [(1, "mail <EMAIL> now", "en", "s", 16, "x"), (None, None, None, None, None, None), (2, "", "en", "s", 0, "y")], key=str
    )


def test_clashing_column_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a@b.co", 5)], "doc_id bigint, text string, pii int")
    assert pii.redact(docs).columns == ["doc_id", "text", "pii"]
    assert tuple(pii.redact(docs).first()) == (1, "<EMAIL>", 5)
    assert pii.pii_report(docs.limit(0)).count() == 0
    assert pii.pii_report(docs.union(docs)).count() == 2


def test_overlapping_spans_are_replaced_once():
    text = "a@1.2.3.4 end"
    assert pii.redacted(text, pii.find_spans(text)) == "<EMAIL> end"


IBANS = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "NO93 8601 1117 947",
         "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606"]


def test_account_numbers_end_before_what_stands_behind_them():
    behind = ["", " BIC COBADEFF", " EUR 500", " 2024 01 31", " 31.01.2024", " VAT NR 17", " A", " 5", ", BIC X", " Bank", "\nBIC X"]
    for number in IBANS:
        for tail in behind:
            for lead in ("IBAN ", "", "REF AB12 CODE 77 "):
                spans = [s for s in pii.find_spans(f"{lead}{number}{tail}") if pii.KINDS[s.kind] == "iban"]
                assert [(s.start, s.end) for s in spans] == [(len(lead), len(lead) + len(number))], (lead, number, tail)


def test_account_numbers_behind_each_other():
    text = " ".join(IBANS)
    found = [text[s.start : s.end] for s in pii.find_spans(text) if pii.KINDS[s.kind] == "iban"]
    assert found == IBANS
    assert not [s for s in pii.find_spans("IBAN DE88 3704 0044 0532 0130 00 BIC COBADEFF") if pii.KINDS[s.kind] == "iban"]


def test_secrets_of_longer_names():
    value = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    for lead in ("token = ", "GITHUB_TOKEN=", "access_token=", "client_secret: ", "api-key: ", '"x-api-key": "', "AWS_SECRET_ACCESS_KEY=",
                 "apiKey=", "--password-file-2=", "url=aaaaaaaaaaaaaaaa/token=", "étoken: "):
        spans = [s for s in pii.find_spans(lead + value) if pii.KINDS[s.kind] == "secret"]
        assert [(s.start, s.end) for s in spans] == [(len(lead), len(lead) + len(value))], lead
    assert not [s for s in pii.find_spans(f"commit: {value}") if pii.KINDS[s.kind] == "secret"]


def test_long_runs_of_key_names_take_linear_time():
    assert pii.find_spans("token" * 100_000) == [] == pii.find_spans("x" * 500_000)


def test_long_runs_cost_linear_time():
    million = 1_000_000
    texts = ["7" * million, "a" * million + "@", "a" * million + "@b.co", "0" * million + ".1.1.1", "1." * 50_000, "a@" * (million // 2),
             "+1" + "(" * million, "+1" * (million // 2), "x_" * (million // 2), "AB12" * (million // 4), "a@b.c_d@e.f"]
    for text in texts:
        began = time.process_time()
        found = pii.find_spans(text)
        assert time.process_time() - began < 2, text[:20]
        if len(text) < 100:
            assert [(s.start, s.end) for s in found] == [(0, 5), (5, 11)]
    assert [(s.start, s.end) for s in pii.find_spans(texts[2]) if s.kind == 0] == [(0, million + 5)]


def test_addresses_equal_plain_search(rng):
    for _ in range(3000):
        text = "".join(rng.choice("ab1._@@-. \n\u00e9") for _ in range(rng.randrange(40)))
        want = [label for label in plain(text) if label.startswith(("email", "ip"))]
        assert [s.label() for s in pii.find_spans(text) if s.kind < 2] == want
    for _ in range(3000):
        text = "".join(rng.choice("0125..x") for _ in range(rng.randrange(40)))
        assert [s.label() for s in pii.find_spans(text) if s.kind == 1] == [x for x in plain(text) if x.startswith("ip")]
