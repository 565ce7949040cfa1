import random

from barloom.llm import packing, tokens
from barloom.llm.packing import fill, pack


def brute(sizes, capacity, linear, quadratic):
    boxes = [[capacity, 0.0] for _ in range(-(-sum(sizes) // capacity))]
    out = []
    for n in sizes:
        fits = [(b[1], i) for i, b in enumerate(boxes) if b[0] >= n]
        i = min(fits)[1] if fits else len(boxes)
        if not fits:
            boxes.append([capacity, 0.0])
        boxes[i][0] -= n
        boxes[i][1] = boxes[i][1] + linear * n + quadratic * n * n
        out.append(i)
    return out


def test_fill_is_the_rule():
    rnd = random.Random(9)
    for capacity in (7, 64, 100):
        for _ in range(40):
            sizes = sorted((rnd.choice([1, rnd.randint(1, capacity)]) for _ in range(rnd.randint(0, 80))), reverse=True)
            assert fill(sizes, capacity, 1.0, 1 / capacity) == brute(sizes, capacity, 1.0, 1 / capacity)
    assert fill([], 5, 1.0, 0.0) == []


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 16)
    rnd = random.Random(10)
    words = ["open", "high", "low", "close", "kurs", "venta"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(int(rnd.paretovariate(1.1) * 8))), "hot" if i % 3 else "x") for i in range(700)]
    rows += [(1000, "", "x"), (1001, None, "x"), (0, rows[0][1], "copy"), (1002, "q" * 900, "x")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string, container string"), 64).collect()
    tok = tokens.tokenizer(tokens.RANKS)
    text = dict((r[0], r[1]) for r in rows)
    load, cut = {}, {}
    for r in got:
        load[r.container] = load.get(r.container, 0) + r.n_tokens
        cut.setdefault(r.doc_id, []).append(r)
        assert tok.count(text[r.doc_id][r.start_char : r.end_char]) == r.n_tokens
    assert max(load.values()) <= 64
    assert set(cut) == {d for d, t, _ in rows if t} and len(cut[0]) == 2 * len({r.piece_no for r in cut[0]})
    for d, parts in cut.items():
        if d:
            parts.sort(key=lambda r: r.piece_no)
            assert "".join(text[d][r.start_char : r.end_char] for r in parts) == text[d]
            assert len(parts) == 1 or tok.count(text[d]) > 64
    assert sum(load.values()) / (len(load) * 64) > 0.95
    assert pack(spark.createDataFrame([], "doc_id long, text string"), 64).count() == 0
