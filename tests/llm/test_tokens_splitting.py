import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.llm import tokens
from barloom.llm.splitting import CLAUSE, LINE, MARK, PARAGRAPH, RECORD, SENTENCE, WORD, boundaries, full_pieces, pieces, split_long, structure

LIMIT, OVERLAP = 128, 16


@pytest.fixture(scope="module")
def tok():
    return tokens.tokenizer(tokens.RANKS)


def texts():
    rnd = random.Random(7)
    words = ["bar", "funding", "Überschuss", "liquidación", "zeitreihe", "a", "the", "0.00125", "BTC_240329", "naïve"]
    prose = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "", ",", ".", ".\n", "\r\n\r\n", "\n\n"]) for _ in range(n))
    return {
        "prose": prose(900),
        "one long word": "x" * 6000,
        "no spaces, wide": "".join(rnd.choice("交易所维护公告，。行情") for _ in range(900)),
        "emoji": "🜁🜂🜃" * 120,
        "white": " " * 3000 + "\n" * 300 + "\t" * 500 + "end",
        "base64": "".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(4000)),
        "lines": "\n".join(f"2024-01-01T00:00:{i % 60:02d}Z level=info id={i}" for i in range(300)),
        "json": '{"k":' * 400 + "1" + "}" * 400,
        "mixed ends": "a b c.\r\nd e f!\rg h\n" * 120,
    }


@pytest.mark.parametrize("name", list(texts()))
def test_pieces(tok, name):
    text = texts()[name]
    got = pieces(text, tok, LIMIT, OVERLAP)
    assert "".join(text[c:e] for _, c, e, _ in got) == text  # nothing lost, nothing twice
    assert all(n == tok.count(text[s:e]) <= LIMIT for s, _, e, n in got)
    assert got[0][0] == 0 and len(got) > 1
    for (s0, _, e0, _), (s, c, _, _) in zip(got, got[1:], strict=False):
        assert s0 < c == e0 and s <= c
        if name not in ("emoji",):
            assert tok.count(text[s:c]) >= OVERLAP - 3  # ends may join differently when counted alone
    assert len(got) <= 4 * tok.count(text) / (LIMIT - OVERLAP) + 2


@pytest.mark.parametrize("name", list(texts()))
def test_full_pieces(tok, name):
    text = texts()[name]
    got = full_pieces(text, tok, LIMIT)
    assert "".join(text[s:e] for s, _, e, _ in got) == text
    assert all(n == tok.count(text[s:e]) <= LIMIT for s, _, e, n in got)
    assert all(n >= LIMIT * 7 // 8 - 8 for *_, n in got[:-1])


def test_cuts_at_the_strongest_boundary(tok):
    left, right = "alpha beta. " * 20, "gamma delta. " * 20
    text = left + "\n\n" + right
    got = pieces(text, tok, tok.count(text) - 10, 0)
    assert [text[c:e] for _, c, e, _ in got] == [left + "\n\n", right]


def test_boundaries():
    kinds = [(PARAGRAPH, r"(?:\r\n|\r(?!\n)|(?<!\r)\n)[ \t]*(?:\r\n|\r(?!\n)|\n)\s*"), (LINE, r"\r\n|\r|\n"), (SENTENCE, r"[.!?…][\"')\]]{0,3}\s+|[。！？]"), (CLAUSE, r"[,;:]\s+|[，；：、]"), (WORD, r"\s+")]
    for text in [*texts().values(), 'a "b." c.\n\n  d,  e\r\n\r\nf。g\r\rh?) i!', " ", "", "\n", "x\n \n", "。", "a.')] b"]:
        want = [0] * (len(text) + 1)
        for rank, p in kinds:
            for m in re.finditer(p, text):
                want[m.end()] = max(want[m.end()], rank)
        want[0] = want[-1] = 0
        assert boundaries(text).tolist() == want


def test_minified_json_is_cut_between_records(tok):
    rnd = random.Random(3)
    text = "[" + ",".join(f'{{"E":{rnd.randint(10**12, 10**13)},"s":"NOVUSDV","k":{{"o":"{rnd.random():.4f}","x":true}},"b":[["{rnd.random():.4f}","1"],["2","3"]]}}' for _ in range(200)) + "]"
    assert not re.search(r"\s", text)
    for got in (pieces(text, tok, 1024, 64), full_pieces(text, tok, 1024)):
        assert "".join(text[c:e] for _, c, e, _ in got) == text and len(got) > 5
        assert all(n == tok.count(text[s:e]) <= 1024 for s, _, e, n in got)
        assert all(text[c - 2 : c + 1] == "},{" for _, c, _, _ in got[1:])
    one = '{"k":[' + ",".join(f'"{rnd.randint(10**8, 10**9)}"' for _ in range(600)) + "]}"  # a single record: between its values
    assert all(text[c - 1] == "," for text in (one, one.replace('"', "")) for _, c, _, _ in pieces(text, tok, 1024, 64)[1:])
    code = "".join(f"f{i}(x{i});" for i in range(600))
    assert all(code[c - 1] == ";" for _, c, _, _ in pieces(code, tok, 1024, 64)[1:])


def test_marks_are_weaker_than_words(tok):
    text = "alpha beta gamma " * 30 + ",".join("{}" for _ in range(40)) + " " + "delta " * 90
    assert all(text[c - 1] == " " for _, c, _, _ in pieces(text, tok, LIMIT, OVERLAP)[1:])
    assert structure("").tolist() == [0] and structure("}").tolist() == [0, 0]
    assert structure('[{"a":1,"b":2},{"c":3}]').tolist() == [0] * 8 + [MARK] + [0] * 6 + [RECORD] + [0] * 8
    assert not any(structure("a, b; c,\n{ } }])"))


def test_boundary_outside_the_middle_half(tok):
    rnd = random.Random(4)
    blob = "".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(1000))
    size = tok.count(blob)
    for text, at in (("alpha " * (size // 5) + blob, size // 5 * 6), (blob + " omega" * (size // 5), len(blob) + 1)):
        limit = tok.count(text) - 20
        got = pieces(text, tok, limit, 0)
        assert [c for _, c, _, _ in got] == [0, at] and all(n <= limit for *_, n in got)
    text = "alpha " + "".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(20000)) + " omega"  # two short pieces at most, then halves
    got = pieces(text, tok, LIMIT, OVERLAP)
    assert got[0][2] == 6 and got[-1][1] == len(text) - 5
    assert "".join(text[c:e] for _, c, e, _ in got) == text and all(n == tok.count(text[s:e]) <= LIMIT for s, _, e, n in got)
    assert len(got) <= 2 * tok.count(text) / (LIMIT - OVERLAP) + 4


def test_against_plain_recursion(tok):
    """The same cuts from a direct reading of the rule, every size counted anew from the text's tokens."""
    from barloom.llm.splitting import SLACK, _Text

    text = texts()["prose"]
    x = _Text(text, tok)
    assert x.size(0, len(text)) == tok.count(text)

    def cut(a, b):
        if x.size(a, b) <= LIMIT - OVERLAP - SLACK:
            return [(a, b)]
        n, lo = x.size(a, b), int(x.before[a])
        strength = dict(zip(x.at.tolist(), x.strength.tolist(), strict=True))
        inside = [p for p in range(a + 1, b) if x.char_at(lo + n // 4) <= p <= x.char_at(lo + n - n // 4)]
        best = max(inside, key=lambda p: (strength.get(p, 0), -abs(int(x.before[p]) - lo - n / 2), -p))
        return cut(a, best) + cut(best, b)

    assert [(c, e) for _, c, e, _ in pieces(text, tok, LIMIT, OVERLAP)] == cut(0, len(text))


def test_operator(spark, tok):
    rows = [(i, t, "clash") for i, t in enumerate(texts().values())] + [(100, "short", ""), (101, "", ""), (102, None, ""), (103, " ", ""), (0, texts()["prose"], "again"), (None, texts()["lines"], "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    got = split_long(df, LIMIT, OVERLAP).collect()
    assert {r.doc_id for r in got} == {*range(len(texts())), None}
    assert sum(r.doc_id == 0 and r.piece_no == 0 for r in got) == 2
    assert all(r.piece == rows[r.doc_id][1][r.start_char : r.end_char] for r in got if r.doc_id is not None)
    whole = split_long(df, LIMIT, OVERLAP, keep_short=True).where("doc_id in (100, 103)").collect()
    assert {(r.doc_id, r.piece, r.n_tokens) for r in whole} == {(100, "short", tok.count("short")), (103, " ", 1)}
    assert split_long(df.limit(0), LIMIT, OVERLAP).count() == 0
    for bad in ((10, 10), (10, -1)):
        with pytest.raises(ValueError):
            split_long(df, *bad)


def test_counts(spark, tok, monkeypatch):
    whole = {k: len(tok.enc.encode_ordinary(t)) for k, t in texts().items()}
    monkeypatch.setattr(tokens, "STRETCH", 200)
    for k in ("prose", "lines"):
        assert tok.count(texts()[k]) == whole[k]  # stretches end where the pattern splits anyway
        assert list(tok.ends(texts()[k]))[-1] == len(texts()[k].encode())
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(tokens.token_count(F.col("t"))).collect()] == [2, 0, 0]
    names = spark.createDataFrame([(" Ingest-Log ",), ("INGEST LOG",), ("",), (None,)], "s string")
    assert [r[0] for r in names.select(tokens.canonical_source(F.col("s"))).collect()] == ["ingest_log", "ingest_log", None, None]
    limits = spark.createDataFrame([("p", 10, None)], "profile string, capacity_tokens int, overlap_tokens int")
    assert tokens.capacity(limits, "p") == (10, 0)
    with pytest.raises(ValueError):
        tokens.capacity(limits, "q")


def test_long_texts_are_counted_as_in_one_go(tok, monkeypatch):
    """No text changes its tokens by its length: a megabyte of Chinese, base64 and compact JSON, long runs of one class, white space."""
    import base64
    import random

    rnd = random.Random(41)
    cases = {
        "zh": "".join(rnd.choice("的一是在不了有和人这中大为上个国我以要他时来用们，。") for _ in range(350_000)),
        "zh without marks": "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(150_000)),
        "base64": base64.b64encode(rnd.randbytes(800_000)).decode(),
        "json": "[" + ",".join(f'{{"k{i}":"it\'s","v":{i * 7}}}' for i in range(40_000)) + "]",
        "letters": "ab" * 150_000,
        "contractions": " ".join(rnd.choice(["it's", "don't", "a1", "x-y", "字！", "'tis", "1'2", "\n\n"]) for _ in range(100_000)),
    }
    for name, text in cases.items():
        assert tok.ids(text) == tok.enc.encode_ordinary(text), name
    for text in ("a" + " " * 5000 + "b", "a" + "\n" * 3000, " \t" * 2500 + "\u3000x", " " * 4000):
        assert tok.ids(text) == tok.enc.encode_ordinary(text)
    assert tok.count(" " * 1_000_000 + "x") == 1_000_000  # more than the matcher can hold in one go
    monkeypatch.setattr(tokens, "STRETCH", 60)
    monkeypatch.setattr(tokens, "BLANK_RUN", 3)
    for name, text in cases.items():
        assert tok.ids(text[:20_000]) == tok.enc.encode_ordinary(text[:20_000]), name
