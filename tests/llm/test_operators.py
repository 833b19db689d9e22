"""Each operator against a brute-force version, and on rows that are hard to get through."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, exact_dedup, gbdt, html_extract, pii, quality, sentencepiece_bpe, simhash, suffix_dedup, token_files, toxicity
from lexmill.llm.queries import vocabulary

from .conftest import HARD

TEXTS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(TEXTS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# 1


def brute_removed(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - 99):
            w = raw[a : a + 100]
            if w in seen:
                gone[a : a + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for a in range(len(raw)) if gone[a] and (a == 0 or not gone[a - 1]))
        out[i] = (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot, large", [(10**9, 20_000), (2, 20_000), (10**9, 2)])
def test_suffix_dedup(spark, monkeypatch, hot, large):
    """Also with every anchor dealt by windows, and with every group cut finer."""
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0)
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    shared = prose(1, 40)
    docs = [(i, prose(100 + i, 60) + shared + prose(200 + i, 30)) for i in range(8)]
    docs += [(20, shared[:150]), (21, "ab" * 300), (22, "x" * 99), (23, "x" * 101), (24, None), (25, "\x00é" * 200), (26, docs[0][1])]
    found = rows(suffix_dedup.removal(spark.createDataFrame(docs, "doc_id long, text string")))
    for i, want in brute_removed(docs).items():
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i


def test_window_classes():
    texts = [b"abracadabra" * 12, b"abracadabra" * 11, b"z" * 120]
    size = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    class_, text, offset = suffix_dedup.window_classes(raw, np.cumsum(size) - size, size)
    of = {}
    for c, t, o in zip(class_.tolist(), text.tolist(), offset.tolist(), strict=True):
        of.setdefault(texts[t][o : o + 100], set()).add(c)
    assert all(len(v) == 1 for v in of.values()) and len({next(iter(v)) for v in of.values()}) == len(of)


# 2


def test_sentencepiece(spark):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.Codec(path)
    r = random.Random(5)
    own = ["", " ", "a  b ", "日本語 😀", "<s> </s> <0x41>", "a" * 500, "▁▁a▁", "x\ty\r\n"] + ["".join(r.choice("aeinorst hld.,▁ THé漢\n01") for _ in range(r.randint(1, 60))) for _ in range(2000)]
    for t in own:
        ids = sp.encode(t, add_eos=True)
        assert codec.encode(t) == ids, t
        assert codec.decode(ids) == sp.decode(ids), t
    for _ in range(500):
        ids = [r.randint(3, 258) if r.random() < 0.5 else r.randint(0, 31_999) for _ in range(r.randint(0, 9))]
        assert codec.decode(ids) == sp.decode(ids)


def test_sentencepiece_digests(spark):
    """The query's path against the library: every character of the vocabulary, numbers that are no digits, very long words."""
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    chars = sorted({c for i in range(sp.get_piece_size()) for c in sp.id_to_piece(i) if not sp.is_byte(i)})
    r = random.Random(6)
    own = ["", None, "E=mc². Then", "km². Area", "²."] + ["".join(chars[i : i + 60]) for i in range(0, len(chars), 60)]
    own += ["".join(r.choice(chars if k % 2 else "²³½aé .,;-'1²xyzß漢😀\u200b") for _ in range(r.randint(1, 60))) for k in range(6000)]
    own += ["".join(p.replace("▁", " ") for p in (sp.id_to_piece(r.randint(259, 31_999)) for _ in range(r.randint(1, 30)))) for _ in range(3000)]
    own += ["ab" * 100_000, "漢字" * 100_000, "thand" * 40_000]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").repartition(8)
    for r_ in sentencepiece_bpe.digests(docs, path, with_ids=True).collect():
        ids = sp.encode(own[r_.doc_id] or "", add_eos=True)
        assert list(r_.ids) == ids and r_.n_tokens == len(ids), own[r_.doc_id][:100]
        assert r_.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r_.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_sentencepiece_backtracks():
    """Longest matches alone are wrong for some units; the compatibility check and the bitfield put them right."""
    codec = sentencepiece_bpe.Codec(vocabulary("piece_bpe_32k.model"))
    different = 0
    for seed in range(300):
        unit = "▁" + "".join(random.Random(seed).choice("thandereousingly") for _ in range(14))
        greedy, at = [], 0
        while at < len(unit):
            n = next((n for n in range(len(unit) - at, 1, -1) if unit[at : at + n] in codec.score), 1)
            greedy.append(unit[at : at + n])
            at += n
        assert codec.pieces(unit) == codec.merged(unit)
        different += greedy != codec.pieces(unit)
    assert different > 50


def test_sentencepiece_takes_few_rows_at_a_time():
    """A worker holds the ids of some rows, not of Spark's whole batch."""
    import tracemalloc

    import pyarrow as pa

    path = vocabulary("piece_bpe_32k.model")
    texts = [prose(i % 50, 200) for i in range(4000)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(4000), pa.int64()), "text": pa.array(texts)})
    codec = sentencepiece_bpe.worker(path)[0]
    known = [codec.encode(t) for t in texts[:50]]
    got = []
    list(sentencepiece_bpe._digests(iter([batch.slice(0, 50)]), path, True))  # words are known from now on
    tracemalloc.start()
    for out in sentencepiece_bpe._digests(iter([batch]), path, True):
        assert out.column("ids")[0].as_py() == known[len(got) % 50]
        got += zip(out.column("id").to_pylist(), out.column("n_tokens").to_pylist(), strict=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(i, len(known[i % 50])) for i in range(4000)]
    assert peak < 4 * sum(n for _, n in got) / 2  # of four bytes each


# 3


def base_spans(t: str) -> list[tuple[int, str, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    names = ("email", "ip", "card", "phone")
    return [f"{names[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_pii(spark):
    r = random.Random(9)
    own = ["a@b.com_x@d.org", "1.2.3.4.5.6.7.8 300.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112", "😀 a@b.co +1 (988) 555-2485", "9" * 5000, "1." * 5000, "a" * 50_000 + "@"]
    own += ["".join(r.choice("ab1234567890.@+- ()é") for _ in range(r.randint(5, 200))) for _ in range(1500)]
    found = rows(pii.report(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")))
    for i, t in enumerate(own):
        want = base_spans(t)
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [found[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s.startswith(k + ":") for s in want) for k in ("email", "ip", "card", "phone")]


def test_pii_adds_by_checksum_and_context(spark):
    own = ["pay to GB82 WEST 1234 5698 7654 32 now", "pay to GB82 WEST 1234 5698 7654 33 now", "my ssn is 123-45-6789", "part 123-45-6789 of it"]
    found = rows(pii.report(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")))
    assert [found[i].spans for i in range(4)] == ["iban:7:34", "", "ssn:10:21", ""]


def test_pii_ibans_before_words_and_lists_of_numbers(spark):
    iban = "DE89370400440532013000"
    own = [f"{iban}{tail}" for tail in (" Please send", " BIC COBADEFF", " 4711", " A", ".", " GB82WEST12345698765432", "Please")]
    own += [f"XX12 {iban}", f"no GB12 3456 or {iban} AB", "QQ41 1234 5678 9012 345 AND MORE", "SSNs: 123-45-6789, 234-56-7890", "123-45-6789, 234-56-7890 (SSN)", "ssn " + "x" * 44 + " 123-45-6789", "ssn " + "x" * 43 + " 123-45-6789, 234-56-7890"]
    code = next(f"QQ{k:02d}12345678901234" for k in range(2, 99) if int("12345678901234" + "2626" + f"{k:02d}") % 97 == 1)
    own += [f"{code[:4]} {code[4:]} AND MORE"]
    found = rows(pii.report(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")))
    got = [",".join(s for s in found[i].spans.split(",") if s.startswith(("iban", "ssn"))) for i in range(len(own))]
    assert got[:7] == ["iban:0:22"] * 5 + ["iban:0:22,iban:23:45", ""]
    assert got[7:9] == ["iban:5:27", "iban:16:38"]
    assert got[10:14] == ["ssn:6:17,ssn:19:30", "ssn:0:11,ssn:13:24", "", "ssn:48:59"]
    assert got[14] == "iban:0:19"


def test_pii_context_is_the_text_around_a_span(spark):
    r = random.Random(4)
    own = ["".join(r.choice(["123-45-6789", "234-56-7890", "a@b.co", "+1 988 555 2485", " ssn", " ", ", ", "x" * 20, "é😀", "1.2.3.4"]) for _ in range(r.randint(1, 30))) for _ in range(300)]
    found = rows(pii.report(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")))
    for i, t in enumerate(own):
        all_ = [m for m in re.finditer(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", t)]
        near = [m for m in all_ if re.search("ssn", t[max(0, m.start() - 48) : m.start()]) or re.search("ssn", t[m.end() : m.end() + 48])]
        assert [s for s in found[i].spans.split(",") if s.startswith("ssn")] == [f"ssn:{m.start()}:{m.end()}" for m in near], t


# 4, 6


def auc(y: np.ndarray, p: np.ndarray) -> float:
    order = np.argsort(np.argsort(p)) + 1
    n1, n0 = y.sum(), (1 - y).sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def labelled_docs(spark, bad, n=900):
    """Documents of which those with an id divisible by 3 are made bad."""
    docs = [(i, bad(prose(i, 60), i) if i % 3 == 0 else prose(i, 60)) for i in range(n)]
    labels = [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("make, label, good, by, held", [
    (toxicity.report, "toxic", lambda t, i: t.replace("dolor", ["vermin", "vermina", "verminus"][i % 3 if i % 2 else 0], 3) + " you vermin", 4, 2),
    (quality.report, "quality", lambda t, i: " ".join(w.upper() + "!!" for w in t.split()), 3, 1),
])
def test_classifiers(spark, make, label, good, by, held):
    docs, labels = labelled_docs(spark, good)
    found = make(docs, labels).join(labels, "doc_id").toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % by == held for i in found.doc_id]).all()
    own = found[found.held_out]
    assert auc(own[label].to_numpy(), own.score.to_numpy()) > 0.97
    assert found.score.between(0, 1).all()
    flipped = labels.withColumn(label, F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % by) == held, 1 - F.col(label)).otherwise(F.col(label)))
    again = make(docs, flipped).toPandas().sort_values("doc_id").score.to_numpy()
    assert np.allclose(again, found.sort_values("doc_id").score.to_numpy())  # held-out labels change nothing


def test_gbdt_walk_and_isotonic():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(int)
    m = gbdt.fit(x[:1500], y[:1500])
    assert auc(y[1500:], m.probability(x[1500:])) > 0.98
    by_row = []
    for row in x[1500:1510]:
        total = m.base
        for f, c, leaf in zip(m.feature, m.cut, m.leaf, strict=True):
            node = 0
            while node < len(c):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += leaf[node - len(c)]
        by_row.append(total)
    assert np.allclose(by_row, m.margin(x[1500:1510]))
    p = r.random(500)
    rising = gbdt.isotonic(p, (r.random(500) < p).astype(int))
    assert (np.diff(rising(np.linspace(0, 1, 50))) >= 0).all()


# 5


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    r = np.random.default_rng(1)
    counts = np.array([0, 1, 3, 4, 1000, 0, 5])
    x = (r.integers(0, 2**32, counts.sum()) >> r.integers(0, 32, counts.sum())).astype(np.uint32)
    control, controls, data, sizes = token_files.encode_records(x, counts)
    assert (token_files.decode_records(control, data, counts) == x).all() and controls.sum() == len(control) and sizes.sum() == len(data)
    own = [prose(i, 50) for i in range(40)] + ["It's <|endoftext|> ÀÉ Σας 漢字\x1cx\x85y　z 1234 İ", "", None, "We'll say 'so', e.g. x=y!", "≠ !̸ é"]
    tk, start = Tokenizer.from_file(path), 0
    found = rows(token_files.round_trip(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string"), path, 2))
    for i, t in enumerate(own):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [2]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)


def test_token_files_remember_parts_once():
    """Words made of a few parts take the memory of these parts; ids are the library's, cut at every kind of sign."""
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    of, tk, end = token_files.Words(path), Tokenizer.from_file(path), np.array([2], "<u4")
    some = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(100)]
    texts = [" ".join(f"{a}-{b}" for b in some) for a in some]
    rng = random.Random(5)
    texts += ["".join(rng.choice("abzAZ09'’!&(-@[`{~ \t\n\x1cäß\u0301漢") for _ in range(200)) for _ in range(300)] + ["", "-", "a", "a-", "-a"]
    flat, counts = of.batch(pa.array(["not this", *texts]).slice(1), end)
    for t, own in zip(texts, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == tk.encode(t, add_special_tokens=False).ids + [2], t
    of = token_files.Words(path)
    of.batch(pa.array(texts[:100]), end)
    assert sum(len(m) + len(m.old) for m in vars(of).values() if isinstance(m, dict)) == len(some) + 1


def test_token_files_special_rows(spark):
    """A row with a special token's marks is told by the library alone; its neighbours go on as without it."""
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tk, own = Tokenizer.from_file(path), ["<|endoftext|>", "it's x-y", None, "a <|b", "", "x<|endoftext|>y", "z"]
    found = rows(token_files.round_trip(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").coalesce(1), path, 2))
    for i, t in enumerate(own):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [2]
        assert (found[i].n_tokens, found[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t


# 7


def brute_copies(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in docs:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    return {i: (min(groups[norm(t)])[1], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in docs}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, weak):
    """Also with a digest that clashes all the time: contents are compared, not digests."""
    r = random.Random(2)
    own = [(i, r.choice(["a b", "ab", "a  b", "b a", "", " ", None, "c\td", "cd", "é"])) for i in range(200)]
    digest = (lambda n: F.length(n).cast("string")) if weak else (lambda n: F.sha2(n, 256))
    found = rows(exact_dedup.annotate(spark.createDataFrame(own, "doc_id long, text string"), salts=3, digest=digest))
    for i, (keep, size, sha) in brute_copies(own).items():
        f = found[i]
        assert (f.keep_id, f.group_size, f.kept) == (keep, size, keep == i)
        assert weak or f.text_sha256 == sha
    assert {r.doc_id for r in exact_dedup.dedup(spark.createDataFrame(own, "doc_id long, text string")).collect()} == {k for k, _, _ in brute_copies(own).values()}


def test_groups_of_copies_are_written_by_size(spark, monkeypatch):
    files = {}

    def counted(df, name, put=exact_dedup.written):
        out = put(df, name)
        files[name] = len([f for f in out.inputFiles() if "part-" in f])
        return out

    monkeypatch.setattr(exact_dedup, "written", counted)
    long = [np.random.default_rng(i % 60).bytes(150_000).hex() for i in range(120)]  # 18 MB, so that the texts' partitions are not joined
    found = rows(exact_dedup.annotate(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")))
    assert all((found[i].keep_id, found[i].group_size) == (i % 60, 2) for i in range(120))
    assert files == {"copies": 1}


# 8


def test_html_extract(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body class="nav-fixed"><header>Site <a href=/>Home</a></header><nav><ul><li><a href=/a>One</a></ul></nav>
    <div class="cookie-notice">We use cookies to make this site better for you.</div><article><h1>Big &amp; small</h1><p>First   paragraph,<br>with <b>bold</b> text.<p>Second &lt;one&gt;.
    <div class=ad>Buy this now, cheap!</div><script>var t="</p>";</script><p>Third.</article><section id="comments"><p>I liked it a lot, thank you, really.</section><form>Name <input><button>Go</button></form><footer>&copy; me</footer>"""
    want = "Big & small First paragraph, with bold text. Second <one>. Third."
    own = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<nav>only</nav>"), (5, "u", "plain < text"), (6, "u", "<!-- never closed"), (7, "u", "<p>" * 20_000 + "deep")]
    found = rows(html_extract.extract(spark.createDataFrame(own, "page_id long, url string, html string")), "page_id")
    assert [found[i].text for i in range(1, 8)] == [want, "", "", "", "plain < text", "", "deep"]
    assert found[1].n_chars == len(want)


def cut_cost(margins, links, label, unit=64):
    """In the operator's units, with terminals as large as they are."""
    own = [round(m * unit) for m in margins]
    return sum(max(0, m) if not x else max(0, -m) for m, x in zip(own, label, strict=True)) + sum(round(w * unit) for i, j, w in links if label[i] != label[j])


def test_minimum_cut():
    """labels() costs as little as the best of all labellings, and has the least content of the best ones."""
    r = random.Random(3)
    flipped = 0
    for _ in range(300):
        n = r.randint(1, 9)
        margins = [r.choice([0, r.uniform(-3, 3)]) for _ in range(n)]
        links = [(i, j, r.uniform(0, 2)) for i in range(n) for j in range(i) if r.random() < 0.5]
        found = html_extract.labels(margins, links)
        every = [[bool(k >> i & 1) for i in range(n)] for k in range(2**n)]
        best = min(cut_cost(margins, links, x) for x in every)
        assert cut_cost(margins, links, found) == best
        assert sum(found) == min(sum(x) for x in every if cut_cost(margins, links, x) == best)
        flipped += sum((m > 0) != x for m, x in zip(margins, found, strict=True))
    assert flipped > 100


def article_text(page: str) -> str:
    """The blocks of <article>, read with the standard library's parser; for pages whose article is marked as one."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        inside, out = False, [""]

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            self.out.append("") if tag not in ("b", "a", "br") else self.handle_data(" ") if tag == "br" else None

        def handle_endtag(self, tag):
            self.out.append("") if tag not in ("b", "a") else None
            self.inside &= tag != "article"

        def handle_data(self, data):
            if self.inside:
                self.out[-1] += data

    reader = Reader(convert_charrefs=True)
    reader.out = [""]
    reader.feed(page)
    reader.close()
    return " ".join(x for x in (" ".join(b.split()) for b in reader.out) if x)


def test_html_extract_marked_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = rows(html_extract.extract(pages), "page_id")
    for r in pages.collect():
        assert found[r.page_id].text == article_text(r.html), r.page_id
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_the_cut_decides():
    """Without marks in the page, neighbours decide what a block alone does not show; class words count one by one."""
    long = "This is one of the long sentences that an article has, with commas, and with an end to it. " * 2
    soup = f"<div>{long}</div><div>Be</div><div>{long}</div><div>Erin</div><div>{long}</div>"
    found = html_extract.blocks(soup)
    own = [m > 0 for m in html_extract.margins(found)]
    assert own == [True, False, True, False, True]
    assert html_extract.labels(html_extract.margins(found), html_extract.edges(found)) == [True] * 5
    links = "".join(f"<li><a href=/{k}>{w}</a></li>" for k, w in enumerate(["One", "Two", "All of our news, sorted by day"] + ["More"] * 4))
    page = f"<body><div class='content has-sidebar'><article><h1>Head</h1><p>{long}<math><mi>x</mi></math></p><p>Be.</p></article><div class=sidebar><p>{long}</p></div></div><ul>{links}</ul></body>"
    assert html_extract.main_text(page) == " ".join(f"Head {long}x Be.".split())
    wrapped = f"<div class='page sidebar-right'><main><p>{long}</p></main></div><section class=comments><article class=comment><p>{long}</p></article></section>"
    assert html_extract.main_text(wrapped) == long.strip()
    assert html_extract.main_text(f"<article><p>{long}</p><textarea>typed</textarea><object><p>In place of a film, here is a text that says as much.</p></object></article>").endswith("says as much.")


def test_html_extract_takes_linear_time():
    import time

    began = time.perf_counter()
    for page in ("<a " * 1_000_000, "<div>a" * 100_000, "<div>" * 100_000 + "</p>" * 100_000, '<a x="' * 200_000 + ">", '<a ">' * 200_000, "<!-- " * 200_000, "<b class=ad>" * 50_000 + "</b>" * 50_000, "<p>Be. " * 50_000):
        html_extract.main_text(page)
    assert time.perf_counter() - began < 60


def test_html_extract_hard_rows(spark):
    twice, nameless, long = "A row that is there twice, word for word.", "A row without an id, and with enough words.", "A very long text, in one block. " * 100_000
    own = [(1, "u", f"<p>{twice}</p>")] * 2 + [(None, None, None), (None, "v", f"<p>{nameless}</p>"), (2, "u", f"<p>{long}</p>")]
    pages = spark.createDataFrame(own, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("id", "text", "n_chars")})
    found = html_extract.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in found.collect()) == [(0, 0), (0, len(nameless)), (1, len(twice)), (1, len(twice)), (2, len(long) - 1)]
    assert html_extract.extract(pages.limit(0)).count() == 0


# 9


def slow_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    names = sorted(fps)
    root = {i: i for i in names}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(names)):
        for b in range(a):
            if (fps[names[a]] ^ fps[names[b]]).bit_count() <= 4:
                x, y = sorted((top(names[a]), top(names[b])))
                root[y] = x
    return {i: top(i) for i in names}


@pytest.mark.parametrize("hot", [16_384, 3, 1])
def test_simhash(spark, hot):
    """Also with every key dealt anew, and cut into pairs of parts in the end."""
    own = [(i, prose(i % 25, 300) + (f" extra{i}" if i >= 25 else "")) for i in range(80)] + [(100, None), (101, " \n"), (102, "One"), (103, "ONE"), (104, "a b c"), (105, "É é")]
    found = rows(simhash.classes(spark.createDataFrame(own, "doc_id long, text string"), hot=hot))
    fps = {i: slow_fingerprint(t) for i, t in own}
    assert {i: found[i].fingerprint for i in fps} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: found[i].component_id for i in fps} == brute_components(fps)


def test_gray_index():
    r = np.random.default_rng(4)
    base = r.integers(0, 2**63, 30, dtype=np.uint64)
    near = np.concatenate([base] + [base ^ (np.uint64(1) << r.integers(0, 64, 30, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 30, dtype=np.uint64)) for _ in range(20)])
    fps = np.unique(near)
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    assert (simhash.gray_rank(np.arange(16, dtype=np.uint64) ^ np.arange(16, dtype=np.uint64) >> np.uint64(1)) == np.arange(16)).all()
    got = {(int(i), int(j)) for a, b in simhash.near_pairs(fps) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4).tolist() if i < j}
    assert got == want


def test_gray_index_with_a_key():
    """stars() finds the components of all links that differ in no bit of the key, whatever bits it has."""
    r = np.random.default_rng(8)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    near = np.concatenate([base] + [base ^ (np.uint64(1) << r.integers(0, 64, 40, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 40, dtype=np.uint64)) for _ in range(30)])
    fps = np.unique(near)
    for mask in (*simhash._pair_masks()[:3], simhash.longer(simhash._pair_masks()[4])[2]):
        u, v = simhash.stars(fps, mask)
        got = dict(zip(u.tolist(), v.tolist(), strict=True))
        groups = {}
        for x in fps.tolist():
            groups.setdefault(got.get(x, x), set()).add(x)
        near = {x: [y for y in fps.tolist() if (x ^ y).bit_count() <= 4 and not (x ^ y) & mask] for x in fps.tolist()}
        want = []
        left = set(near)
        while left:
            stack, own = [left.pop()], set()
            while stack:
                x = stack.pop()
                own.add(x)
                stack += [y for y in near[x] if y not in own]
            left -= own
            want.append(frozenset(own))
        assert set(want) == set(map(frozenset, groups.values()))


def test_every_link_is_in_a_table():
    r = random.Random(1)
    for _ in range(500):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), 4):
            b ^= 1 << k
        masks = simhash._pair_masks()
        for _ in range(simhash.REFINED + 1):
            masks = [m for m in masks if not (a ^ b) & m]
            assert masks
            masks = [x for m in masks for x in simhash.longer(m)]


def test_simhash_hot_fingerprint(spark):
    """A fingerprint with most of all rows, and a component with a hub of many."""
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("one text for two rows of three")).otherwise(F.concat_ws(" ", F.lit("x"), (F.col("id") % 50).cast("string"))).alias("text"))
    found = simhash.classes(docs)
    counts = {r.component_id: r["count"] for r in found.groupBy("component_id").count().collect()}
    assert sum(counts.values()) == 200_000 and counts[1] == 133_333


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 100)], "u long, v long")
    assert {r.u: r.v for r in simhash.components(edges).collect()} == {**{i: 0 for i in range(1, 61)}, 200: 100}


# 10


def test_decontamination(spark):
    items = [(k, prose(900 + k, 30)) for k in range(6)] + [(6, "tiny one here"), (7, None), (8, "...")]
    changed = lambda t, every: " ".join("zzz" if i % every == every - 1 else w for i, w in enumerate(t.split()))
    docs = [(k, f"{prose(50 + k, 40)} {items[k][1].upper()} {prose(60 + k, 40)}") for k in range(3)]
    docs += [(10, f"x y {changed(items[3][1], 6)} z"), (11, f"x {changed(items[4][1], 2)} z"), (12, " ".join(items[5][1].split()[:10] + ["new"] + items[5][1].split()[10:])), (13, "a Tiny, one\nhere b"), (14, "tiny one"), (15, None), (16, prose(77, 400))]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(0, 0), (1, 1), (2, 2), (10, 3), (12, 5), (13, 6)}


def brute_similarity(item: list[str], doc: list[str]) -> float:
    """The largest share of the passage's words that one diagonal of the document has in place."""
    best = 0
    for shift in range(1 - len(item), len(doc)):
        best = max(best, sum(0 <= i + shift < len(doc) and doc[i + shift] == w for i, w in enumerate(item)))
    return best / len(item)


def test_decontamination_against_brute_force(spark):
    """Words substituted at random places: what holds 0.8 of a passage on one diagonal is found, what holds less on all is not."""
    r = random.Random(12)
    word = lambda: r.choice(TEXTS) + r.choice(TEXTS)
    items = [(k, [word() for _ in range(r.randint(12, 120))]) for k in range(40)]
    docs = []
    for i in range(400):
        k, own = items[i % 40]
        share = r.choice([0, 0.05, 0.1, 0.15, 0.19, 0.3, 0.5])
        lost = set(r.sample(range(len(own)), int(share * len(own))))
        inside = [f"new{j}" if j in lost else w for j, w in enumerate(own)]
        docs.append((i, k, [word() for _ in range(r.randint(0, 60))] + inside + [word() for _ in range(r.randint(0, 60))]))
    found = decontaminate.contaminated(spark.createDataFrame([(i, " ".join(t)) for i, _, t in docs], "doc_id long, text string"), spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string"))
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    near = {(i, k): brute_similarity(items[k][1], t) for i, k, t in docs}
    want = {pair for pair, s in near.items() if s >= 0.8}
    assert len(want) > 200 and len(got & want) / len(want) >= 0.98, len(got & want) / len(want)
    assert got <= want


def test_decontamination_hard_rows(spark):
    """Rows without an id are judged each by its own text; long and repeated rows; names that clash."""
    items = spark.createDataFrame([(1, prose(1, 30)), (1, prose(2, 30)), (None, prose(3, 30)), (None, prose(3, 30))], "item_id long, text string")
    halves = [(None, prose(1, 30)[:110]), (None, prose(1, 30)[110:])]
    own = [*halves, (5, prose(4, 100_000) + " " + prose(2, 30)), (6, prose(1, 30)), (6, "else"), (6, prose(1, 30)), (None, f"x {prose(3, 30)} y")]
    docs = spark.createDataFrame(own, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_id", "_of", "seed", "first", "words")})
    found = sorted((x.doc_id or 0, x.item_id or 0) for x in decontaminate.contaminated(docs, items).collect())
    assert found == [(0, 0), (5, 1), (6, 1)]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id or 0, x.text) for x in kept.collect()) == sorted([*((0, t) for _, t in halves), (6, "else")])


# all


def test_hard_rows(spark, hard, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (None, None)], "item_id long, text string")
    piece, word = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")
    whole = [
        lambda d: suffix_dedup.removal(d), lambda d: sentencepiece_bpe.digests(d, piece), lambda d: pii.report(d), lambda d: toxicity.report(d, labels), lambda d: token_files.round_trip(d, word, 2),
        lambda d: quality.report(d, labels), lambda d: exact_dedup.annotate(d), lambda d: simhash.classes(d),
    ]
    for f in whole:
        assert f(hard).count() == len(HARD)
        assert f(none).count() == 0
    assert {r.doc_id for r in decontaminate.contaminated(hard, items).collect()} == {1, 2}
    assert decontaminate.contaminated(none, items).count() == decontaminate.contaminated(hard, items.limit(0)).count() == 0
    for f in (exact_dedup.dedup, simhash.keep_one, lambda d: decontaminate.drop_contaminated(d, items), lambda d: toxicity.keep_clean(d, d.select("doc_id", "text"), labels)):
        assert f(hard).columns == hard.columns and f(none).count() == 0
    assert sorted((r.doc_id or -1) for r in exact_dedup.dedup(hard).collect()) == [-1, 1, 5, 6, 7, 8, 9]
    assert toxicity.report(hard, labels.limit(0)).select("score").distinct().count() == 1
