"""Language, URLs, BPE, decontamination and personal data: operators that map over rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
from edge_rows import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from abode.llm import bpe, decontam, langid, pii, urlglob
from abode.llm.queries import URL_RULES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_languages(documents, edge, nothing):
    rows = langid.predict_languages(documents).collect()
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and held and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    odd = langid.predict_languages(edge).collect()
    assert Counter(r["doc_id"] for r in odd) == Counter(e[0] for e in EDGE)
    for r in odd:
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 4))
    assert langid.predict_languages(nothing).collect() == []
    assert langid.identify(edge, langid.Profiles({})).where("lang_pred <> 'und'").count() == 0


def test_bundles_are_the_sum_of_bound_vectors():
    text = "Ab, ça"
    base = np.random.default_rng(langid.SEED).integers(0, 2, (langid.SYMBOLS, langid.DIM), dtype=np.int8).astype(int) * 2 - 1
    codes = [0, *(int(langid.letters()[ord(c)]) for c in "Ab"), 0, *(int(langid.letters()[ord(c)]) for c in "ça"), 0]
    want = sum(np.roll(base[a], 2) * np.roll(base[b], 1) * base[c] for a, b, c in zip(codes, codes[1:], codes[2:]))
    assert np.array_equal(langid.bundles([langid.grams(text)])[0], want)
    long = "".join(random.Random(1).choice("abc dé") for _ in range(20000))
    a, b = langid.grams(long)
    langid.MANY, keep = 10**9, langid.MANY
    c, d = langid.grams(long)
    langid.MANY = keep
    assert np.array_equal(a, c) and np.array_equal(b, d)


def fits(rule, host, path):
    rhost, _, rpath = rule.name.partition("/")
    return (host == rhost or host.endswith("." + rhost)) and path.startswith("/" + rpath)


def test_urls(spark, nothing):
    hosts = ["example.org", "EXAMPLE.org", "a.b.example.org", "xexample.org", "org", "evil.com", "com", "a.com:80", "u@a.com", "net", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/fr/", "/fr/#a", "/de/x", "?/de/", "#/es/", "/a.org/es/", "/ü/é"]
    urls = [f"{s}{h}{p}" for s in ("https://", "x://y://", "") for h in hosts for p in paths] + [None, "", "://", "http://", "x" * 5000 + "://a.org/" + "y" * 5000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "url as host", "1 as verdict")
    rows = {r["page_id"]: r for r in urlglob.filter_urls(df, URL_RULES).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
        best = max((r for r in URL_RULES if fits(r, host, path)), key=lambda r: len(r.name), default=None)
        got = rows[i]
        assert (got["host"], got["path"]) == (host, path)
        assert (got["rule"], got["verdict"]) == ((best.name, best.verdict) if best else (None, "allow")), u
    assert urlglob.filter_urls(nothing.selectExpr("doc_id as page_id", "text as url"), URL_RULES).collect() == []


def glob(pattern):
    return re.compile("(?s)" + re.sub(r"\\\*\\\*|\\\*", lambda m: ".*" if len(m.group()) > 2 else "[^/]*", re.escape(pattern)) + r"\Z")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*.", min_size=1, max_size=30), min_size=1, max_size=12), st.lists(st.text("ab/.ü", max_size=40), min_size=1, max_size=8))
def test_automaton_against_re(globs, urls):
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    machine = urlglob.Automaton([urlglob.Rule("block", g, g) for g in globs])
    for u, k in zip(urls, machine.run(urls)):
        hits = [i for i, r in enumerate(machine.rules) if glob(r.glob).match(u)]
        assert k == (hits[0] if hits else -1)


def test_bpe_rows(documents, edge, nothing):
    tok = Tokenizer.from_file(PATH)
    for df, long in ((edge, 30000), (documents, 4000)):
        rows = bpe.token_report(bpe.encode_texts(df, PATH, long=long), PATH).collect()
        want = Counter()
        for r in df.collect():
            ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
            text = tok.decode(ids, skip_special_tokens=False)
            want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert Counter(map(tuple, rows)) == want
    assert bpe.encode_texts(nothing, PATH).collect() == []


PARTS = ["a", "s", "'", "'s", "'ll", "!!", "  ", " ", "\n", "\n\n", "12", "é", "日本", "　", "\xa0", "the", "ing", "<|endoftext|>", "<|", "\x1c", "😀", "\t"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), st.integers(1, 12))
def test_join_of_any_cut(text, size):
    coder, tok = bpe.coder(PATH), Tokenizer.from_file(PATH)
    lists, at = [], 0
    while at < len(text):
        cut = at + size
        hit = text.find("<|endoftext|>", max(0, cut - 12), cut + 12)
        cut = hit + 13 if 0 <= hit < cut < hit + 13 else cut
        lists.append(coder.encode(text[at:cut]))
        at = cut
    while len(lists) > 1:
        lists = [coder.join(*lists[i : i + 2]) if i + 1 < len(lists) else lists[i] for i in range(0, len(lists), 2)]
    assert (lists or [[]])[0] == tok.encode(text, add_special_tokens=False).ids
    assert coder.decode((lists or [[]])[0]) == text


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("abc", max_size=14))
def test_myers(a, b):
    assert list(decontam.distances(decontam.masks(a), len(a), b)) == [min(edit(a, b[s:e]) for s in range(e + 1)) for e in range(1, len(b) + 1)]
    assert list(decontam.distances(decontam.masks(a), len(a), b, True)) == [edit(a, b[:e]) for e in range(1, len(b) + 1)]


def test_leaks(spark, edge, nothing):
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)).strip()
    items = [(i, line(60 + 17 * i)) for i in range(6)] + [(90, None), (91, "short"), (None, line(80)), (92, "")]
    docs = []
    for i, item in items[:6]:
        k = decontam.budget(len(decontam.normal(item)))
        chars = list(item)
        for at in rng.sample(range(1, len(chars) - 1), k):
            chars[at] = "#"
        docs += [(i, line(300) + " " + "".join(chars).upper() + "\n" + line(200)), (100 + i, line(900))]
    docs += [(200, items[8][1])]
    schema = "doc_id long, text string"
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontam.BLOCK_CHARS, 150):
        rows = decontam.find_leaks(spark.createDataFrame(docs, schema), bench, block_chars=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(i, i) for i in range(6)} | {(200, None)}
    text, own = dict(docs), dict(items)
    for r in rows:
        if r["item_id"] is not None:
            assert edit(decontam.normal(own[r["item_id"]]), decontam.normal(text[r["doc_id"]])[r["start"] : r["end"]]) == r["distance"]
    kept = decontam.drop_leaks(spark.createDataFrame(docs, schema), bench).collect()
    assert {r["doc_id"] for r in kept} == {100 + i for i in range(6)}
    assert decontam.find_leaks(edge, bench).collect() == [] and decontam.find_leaks(nothing, bench).collect() == []
    none = bench.where("false")
    assert decontam.find_leaks(edge, none).collect() == [] and decontam.drop_leaks(edge, none).count() == len(EDGE)


BASE = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+",
    3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_pii(text):
    out = []
    for k, p in BASE.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            ok = (True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0, 9 <= len(digits) <= 15)
            if ok[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@", ".", "..", "a", "-", "_", "1.2.3.4", "256", "255", "0", "4111111111111111", " ", "+1 (555) 123", "555-1234", "+", "(", ")", "é", "٣"]), max_size=25).map("".join))
def test_pii_base_spans(text):
    assert [(s, k, e) for s, k, e, _ in pii.find(text) if k < pii.BASE] == plain_pii(text)


def test_pii_rows(spark, edge, nothing, documents):
    for df in (edge, documents):
        want = Counter()
        for r in df.collect():
            found = plain_pii(r["text"] or "")
            n = Counter(k for _, k, _ in found)
            want[r["doc_id"], n[0], n[1], n[2], n[3], hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found).encode()).hexdigest()] += 1
        assert Counter(tuple(r)[:6] for r in pii.pii_report(df).collect()) == want
    assert pii.pii_report(nothing).collect() == []
    text = "bank account GB82 WEST 1234 5698 7654 32, bad GB83 WEST 1234 5698 7654 32; ssn 123-45-6789; " + "part number of the spare wheel in the left box: 123-45-6789"
    kinds = [(pii.KINDS[k], text[s:e]) for s, k, e, _ in pii.find(text)]
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in kinds and not any("GB83" in v for k, v in kinds if k == "iban")
    assert [k for k, _ in kinds].count("identity") == 1
    assert len(pii.find("a" * 200_000 + "9" * 200_000)) == 0  # in linear time
    masked = pii.mask_pii(spark.createDataFrame([(1, "to a@b.cd now"), (2, None)], "doc_id long, text string")).collect()
    assert [r["text"] for r in masked] == ["to [email] now", None]


def test_every_letter_has_its_own_vector(spark):
    table = langid.letters()
    alphabets = ["абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ", "éèêëàâäßóôöîïñûüç", "αβγδεζηθικλμνξοπρστυφχψω"]
    cjk = [chr(c) for c in (*range(0x4E00, 0xA000), *range(0x3041, 0x3097), *range(0x30A1, 0x30FB), *range(0xAC00, 0xD7A4))]
    for own in (*alphabets, cjk):
        symbols = table[[ord(c) for c in own]]
        assert len(set(symbols.tolist())) == len(own) and 26 < symbols.min() and symbols.max() < langid.SYMBOLS
    assert (table[[ord(c) for c in "ЖÉ"]] == table[[ord(c) for c in "жé"]]).all()
    rows = langid.known_vectors()(table[[ord(c) for c in "".join(alphabets) + "漢字かなカナ한글"]]).astype(int)
    assert np.abs(rows @ rows.T - langid.DIM * np.eye(len(rows))).max() < langid.DIM / 4

    kana = [chr(c) for c in range(0x3041, 0x3097)]
    han = [chr(c) for c in range(0x4E00, 0x5200)]
    rng = random.Random(3)
    # languages of one script that differ in letters which used to share a class: б and ж, both halves of kana and Han
    kinds = {"xa": "бао", "xb": "жао", "ka": kana[::2], "kb": kana[1::2], "ha": han[::2], "hb": han[1::2]}
    lexicon = {k: ["".join(rng.choice(own) for _ in range(4)) for _ in range(30)] for k, own in kinds.items()}
    texts = [(i, "".join(rng.choice(lexicon[k]) for _ in range(60)), k) for i, k in enumerate(list(kinds) * 30)]
    found = langid.predict_languages(spark.createDataFrame(texts, "doc_id long, text string, lang string")).collect()
    assert all(r["lang_pred"] == texts[r["doc_id"]][2] for r in found) and any(r["held_out"] for r in found)


def test_counts_added_up_in_parts():
    rng = random.Random(6)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300)) for _ in range(20)] + ["plain words"] * 3
    found = [langid.grams(t) for t in texts]
    whole = langid.bundles(found)
    full, cells = langid.FULL, langid.CELLS
    langid.FULL, langid.CELLS = 500, 2000
    try:
        parts, total = langid.bundles(found), langid._Sum()
        for codes, counts in found:
            total.add(codes, counts)
        assert np.array_equal(parts, whole) and np.array_equal(total.total(), whole.sum(axis=0))
    finally:
        langid.FULL, langid.CELLS = full, cells


def test_without_profiles_texts_with_letters_stay(edge):
    want = Counter(e[0] for e in EDGE if any(c.isalpha() for c in e[1] or ""))
    for profiles in (langid.Profiles({}), langid.Profiles(langid.train(edge))):
        assert Counter(r["doc_id"] for r in langid.drop_unknown(edge, profiles).collect()) == want
