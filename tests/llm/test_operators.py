"""Each operator against a brute-force version, with nulls, empty and long texts, ties and copies."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from facilitymetrics.llm import html_text, near_dup, packing, secrets, toxicity, warc
from facilitymetrics.llm.components import components
from facilitymetrics.llm.decontam import contained_items, without_leaks
from facilitymetrics.llm.near_dup import near_duplicates
from facilitymetrics.llm.queries import tokenizer_path
from facilitymetrics.llm.repeats import without_repeats
from facilitymetrics.llm.vector_dup import near_vectors

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, score string, kept string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Families of near copies, shared passages, copies, and odd texts."""
    rng = random.Random(5)
    passage = sentence(rng, 45, 10**6)
    out = [None, "", "  \t", "one", "one two", "One  TWO", "a b c d e", "é  x y z", "x " * 90, "x " * 120]
    for _ in range(6):
        base = sentence(rng, 120, 10**6).split()
        for changes in (0, 0, 1, 2, 3, 6, 12):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    out += [f"{sentence(rng, 30)} {passage} {sentence(rng, 20)}" for _ in range(8)]
    out += [sentence(rng, 60, 30) for _ in range(10)] + [sentence(rng, 20_000, 10**6)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "s", "k") for k, t in enumerate(texts)]
    rows += [(3, "one", "s", "k"), (None, texts[12], "s", None), (None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def brute_components(ids_sets, similar):
    parent = list(range(len(ids_sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids_sets)):
        for b in range(a):
            if similar(ids_sets[a][1], ids_sets[b][1]):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(ids_sets):
        if i is not None:
            least[find(a)].append(i)
    return [min(least[find(a)], default=None) for a in range(len(ids_sets))]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, width, percent):
    def shingles(text):
        w = WORD.findall(lowered(text))
        return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()

    local = rows_of(docs.select("doc_id", "text"))
    sets = [(i, shingles(t)) for i, t in local]
    same = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)
    expected = brute_components(sets, same)
    out = near_duplicates(docs, width=width, percent=percent)
    got = Counter(rows_of(out.select("doc_id", "n_shingles", "component_id", "kept")))
    assert got == Counter((i, len(s), c, i == c) for (i, s), c in zip(sets, expected))


def test_near_duplicate_rounds_find_what_pairs_find(docs, monkeypatch):
    def result():
        return sorted(rows_of(near_duplicates(docs, width=3, percent=85).select("doc_id", "component_id")), key=str)

    plain = result()
    original = near_dup.links
    # Block links of pivots and cores in place of the comparison one by one.
    source = near_dup.links.__globals__
    monkeypatch.setitem(source, "MOST_ROUNDS", 50)
    monkeypatch.setitem(source, "FEW_PAIRS", 0)
    assert result() == plain and original is near_dup.links


def test_least_shared_bounds_the_tail():
    for similarity in (0.5, 0.8, 0.85):
        n = near_dup.least_shared(48, similarity)
        below = sum(math.comb(48, k) * similarity**k * (1 - similarity) ** (48 - k) for k in range(n))
        assert below <= near_dup.MISSED


def test_near_duplicates_of_nothing(spark, docs):
    assert near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_components_stop_at_stars(spark, monkeypatch):
    made = []
    monkeypatch.setitem(components.__globals__, "written", lambda df, name: made.append(name) or df)
    edges = spark.createDataFrame([(5, 1), (1, 7), (9, 2), (4, 4)], "u long, v long")
    assert dict(rows_of(components(edges))) == {1: 1, 5: 1, 7: 1, 2: 2, 9: 2, 4: 4}
    assert len(made) == 1  # no round was needed


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 2), (9, 9), (7, 5), (5, 6), (8, 6), (None, 1)] + [(k, k + 1) for k in range(20, 60)]
    out = dict(rows_of(components(spark.createDataFrame(edges, "u long, v long"))))
    assert out[3] == 1 and out[9] == 9 and out[8] == out[7] == 5 and {out[k] for k in range(20, 61)} == {20}


def test_contained_items(spark, docs, texts):
    items = [(0, texts[12]), (1, " ".join(texts[13].split()[5:40])), (2, "One two"), (3, None), (4, "  "), (None, "one"),
             (6, "absent words of a benchmark item here"), (7, " ".join(texts[13].split()[:30]) + " q r s t u v w")]
    frame = spark.createDataFrame(items, "item_id long, text string")

    def shingles(words, width):
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}

    expected = Counter()
    for i, text in rows_of(docs.select("doc_id", "text")):
        words = WORD.findall(lowered(text))
        for item, wanted in items:
            own = WORD.findall(lowered(wanted))
            if own:
                width = min(5, len(own))
                need = shingles(own, width)
                n = len(need & shingles(words, width))
                if n >= 0.8 * len(need) - 1e-9:
                    expected[i, item, len(need), n] += 1
    assert expected
    for block in (1 << 20, 40):
        out = contained_items(docs, frame, block_shingles=block)
        assert Counter(rows_of(out.drop("containment"))) == expected
    clean = without_leaks(docs, frame)
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - len({(k[0]) for k in expected if k[0] is not None}) - sum(
        1 for i, t, *_ in docs.collect() if (i is None and t == texts[12]) or (i == 3 and t == "one")
    ) + sum(1 for i in {k[0] for k in expected} if i == 3)
    assert contained_items(docs, frame.where("item_id < 0")).count() == 0
    assert contained_items(docs.where("doc_id < 0"), frame).count() == 0


def test_substring_removal(docs):
    local = rows_of(docs.select("doc_id", "text"))
    words = [WORD.findall(t or "") for _, t in local]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    expected = Counter()
    for (i, _), w in zip(local, words):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        text = " ".join(x for x, g in zip(w, gone) if not g)
        expected[i, len(w), sum(gone), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(rows_of(without_repeats(docs).drop("kept_text"))) == expected
    assert without_repeats(docs.where("doc_id < 0")).count() == 0


SECRETS = [
    "password = 'hunter22' and token:abcdef12", "Api_Key: a token=abcdefg", "PASSWORD=short api-key=zzzzzzzz",
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15, "x" + "0a" * 12 + "é" + "f" * 23, "paſsword=longenough", "tokentoken = 'x.y=zzz'",
    "secret:" + "0123456789abcdef" * 2, None, "",
]


def test_secret_scan(spark):
    docs = spark.createDataFrame([(k % 8, t, "old") for k, t in enumerate(SECRETS * 2)], "doc_id long, text string, spans string")
    keywords = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    rules = [
        (re.compile(rf"({keywords}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
        (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    expected = Counter()
    for k, text in enumerate(SECRETS * 2):
        found = sorted((m.start(), r, m.end()) for r, (p, ok) in enumerate(rules) for m in p.finditer(text or "") if ok(m))
        spans = ",".join(f"{('assign', 'access', 'hex')[r]}:{a}:{b}" for a, r, b in found)
        counts = [sum(x[1] == r for x in found) for r in range(3)]
        expected[(k % 8, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans)] += 1
    ledger = secrets.Ledger(spark)
    out = secrets.scan_documents(docs, ledger=ledger)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert Counter(rows_of(out.select(names))) == expected
    recorded = ledger.rows().count()
    assert recorded == len({t or "" for t in SECRETS})
    # A second scan finds nothing unseen; a new version adds one entry.
    more = docs.union(spark.createDataFrame([(9, "token=brandnew1", "old")], docs.schema))
    again = secrets.scan_documents(more, ledger=ledger)
    assert again.count() == docs.count() + 1 and ledger.rows().count() == recorded + 1
    hidden = secrets.masked(out).where("doc_id = 0").select("text").first()[0]
    assert "hunter22" not in hidden and "abcdef12" not in hidden
    assert secrets.scan_documents(docs.where("doc_id < 0")).count() == 0


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header><h1>Site</h1></header>"
        "<nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div><div id=main-col><h2>Head &amp; more</h2>"
        "<p>First   long paragraph with <b>bold</b> and <a href=x>a link</a> of many words to be the text.<br>Next line &eacute;."
        "<p>Second long paragraph with many words in it so that it stands out from everything else here."
        "<p>Be.</p></div><aside>Side</aside><section id=comments><p>Reader says things of some length here.</p></section>"
        "<form>Name <input></form><footer>Foot</footer></body></html>"
    )
    assert html_text.main_text(page).split("\n") == [
        "Head & more", "First long paragraph with bold and a link of many words to be the text. Next line é.",
        "Second long paragraph with many words in it so that it stands out from everything else here.", "Be.",
    ]
    article = "<div class=ad>Buy<article><header><h1>Title</h1><p>by x</p></header><p>Text of it.</article><footer>F</footer>"
    assert html_text.main_text(article) == "Title\nText of it."
    for nothing in (None, "", "<p>", "<script>x</script>", "<nav>Menu only</nav>"):
        assert html_text.main_text(nothing) == ""
    assert html_text.main_text("plain words") == "plain words"
    assert html_text.main_text("<p>" + "long " * 200_000).startswith("long long")


@pytest.mark.parametrize("part", ["<section>{}</section>", "<div><div>{}</div></div>", "<blockquote>{}</blockquote>", "<ul>{}</ul>", "<table>{}</table>"])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><div>{}</div></main>", "<div id=text>{}</div>", "{}"])
def test_main_text_keeps_lines_around_a_long_part(part, around):
    item = {"<ul>": "<li>{}", "<table>": "<tr><td>{}"}.get(part[: part.index(">") + 1], "<p>{}</p>")
    body = [f"Paragraph {k} of the body " + "with many words in it " * 20 + "." for k in range(30)]
    inner = "<h1>Title</h1><p>lead</p>" + part.format("".join(map(item.format, body))) + "<p>tail</p><p>end</p>"
    menu = "<div><a href=a>One link</a> <a href=b>two</a></div>"
    page = f"<html><body><nav>Menu</nav>{menu if around != '{}' else ''}{around.format(inner)}<footer>Foot</footer></body></html>"
    assert html_text.main_text(page).split("\n") == ["Title", "lead", *(" ".join(x.split()) for x in body), "tail", "end"]


_PROSE = "".join(f"<p>Paragraph {k} of the body {'with many words in it ' * 10}.</p>" for k in range(8))


@pytest.mark.parametrize("part", [
    "<section id=discussion>", "<section id='social-impact'>", "<div class='content with-sidebar'>", "<div class='post no-comments'>",
    "<article class=no-comments>", "<section id=menu>", "<div class=modal>", "<div class='has-sidebar'><div id=header-files>",
])
def test_words_of_a_class_do_not_take_the_text(part):
    page = f"<body><nav>Menu</nav><div class=ad>Buy this now, it is cheap.</div>{part}{_PROSE}"
    found = html_text.main_text(page)
    assert found.startswith("Paragraph 0") and found.count("\n") == 7
    both = html_text.main_text(f"<body><article><h2 id=header-files>Header files</h2>{_PROSE}<section id=discussion><h3>Discussion</h3>{_PROSE}")
    assert both.startswith("Header files\nPar") and "\nDiscussion\n" in both and both.count("\n") == 17


@pytest.mark.parametrize("part", ["id=comments", "class=comment-list", "class='box sidebar-right'", "class=site-footer", "class=cookieNotice", "role=search"])
def test_declared_parts_stay_outside(part):
    found = html_text.main_text(f"<body><article>{_PROSE}</article><div {part}>{_PROSE.replace('Paragraph', 'Other')}</div>")
    assert found.startswith("Paragraph 0") and found.count("\n") == 7


def test_extracted_table(spark):
    pages = spark.createDataFrame([(1, "<p>Some text", "x"), (1, None, "y"), (None, "&#xD800;", None)], "page_id long, html string, text string")
    out = html_text.extracted(pages)
    assert Counter(rows_of(out.select("page_id", "text", "n_chars"))) == Counter({(1, "Some text", 9): 1, (1, "", 0): 1, (None, "�", 1): 1})


def test_token_ids_equal_the_tokenizer():
    encoder = packing.Encoder(tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))
    rng = random.Random(7)
    texts = ["", " ", "a", "a  b", " a", "a ", "a \n b", "x\n \ny", "it's  don't 're", "  b", "a  c", "<|endoftext|> a", "é 12ab"]
    texts += ["".join(rng.choices(list("ab 'sé\n\t1. 　"), k=30)) for _ in range(400)]
    texts += ["".join(chr(rng.randrange(0x250)) for _ in range(40)) for _ in range(2000)] + [chr(k) * 3 for k in range(0x250)]
    plain = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.ids(texts)] == plain


def test_packing(spark, texts):
    rows = list(enumerate(texts)) + [(None, None), (3, "one"), (None, "more words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = packing.packed(docs, tokenizer_path(), 64, tokenizer_path("byte_bpe_50k.tiktoken")).collect()
    encoder = packing.Encoder(tokenizer_path())
    expected = Counter()
    for (i, text), ids in zip(rows, encoder.ids([t or "" for _, t in rows])):
        ids = [*ids.tolist(), 0]
        cut = len(ids) % 64 or 64
        edges = [0, *range(cut, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in out) == expected
    filled = defaultdict(list)
    for r in out:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    least = math.ceil(sum(r["length"] for r in out) / 64)
    assert len(filled) <= least * 1.02 + 1


def test_plan_uses_all_pieces():
    rng = random.Random(1)
    for _ in range(20):
        counts = Counter(rng.randrange(1, 101) for _ in range(rng.randrange(1, 400)))
        made = Counter()
        for lengths, n in packing.plan(counts, 100):
            assert sum(lengths) <= 100 and n > 0
            for x in lengths:
                made[x] += n
        assert made == counts


def test_toxicity(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(600):
        words = [f"word{rng.randrange(300)}x" for _ in range(40)]
        bad = k % 6 == 0
        if bad:
            words[::9] = [rng.choice(["vilest", "grimly"]) if k % 4 else f"zorg{rng.choice('abcdefgh')}" for _ in words[::9]]
        rows.append((k, " ".join(words), "old"))
        labels.append((k, 0, int(bad)))
    rows += [(1000, None, None), (1001, "", None), (None, "vilest vilest", None)]
    labels += [(None, 0, 1), (5000, 0, 1), (1, 0, None), (7, 0, 0), (7, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, evidence string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, marks).collect()}
    for k in range(600):
        assert out[k]["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert out[k]["predicted"] == int(k % 6 == 0) == int(out[k]["score"] >= 0.3)
    assert 0 <= out[1000]["score"] < 0.1 and out[1001]["predicted"] == 0 and out[None]["predicted"] == 1
    assert toxicity.toxicity_scores(docs, marks.where("doc_id < 0")).where("score = 0").count() == docs.count()
    assert toxicity.toxicity_scores(docs.where("doc_id < 0"), marks).count() == 0


def test_toxicity_examples_are_bounded_by_rows(spark, monkeypatch):
    rows = [(k, f"clean{k} words here" + " vilest" * (k % 3 == 0)) for k in range(60)]
    rows += [(3, "vilest again")] * 30 + [(4, f"vilest{'x' * (k % 9)} {k}") for k in range(400)] + [(4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 3 == 0 or k == 4)) for k in range(60)], "doc_id long, toxic int")
    seen = []
    counted = toxicity._vocabulary
    monkeypatch.setattr(toxicity, "_vocabulary", lambda examples: seen.append(examples.collect()) or counted(examples))
    for bound in (10**6, 80):
        monkeypatch.setattr(toxicity, "EXAMPLES", bound)
        assert toxicity.toxicity_scores(docs, marks).count() == len(rows)
    known = Counter(text for k, text in rows if zlib.crc32(str(k).encode()) % 4 != 2)
    assert Counter({r["text"]: r["copies"] for r in seen[0]}) == known and known["vilest again"] == 30
    assert len(seen[1]) == 80 and all(known[r["text"]] == r["copies"] for r in seen[1])


def test_block_max_is_exact():
    rng = np.random.default_rng(4)
    entries = {}
    while len(entries) < 400:
        key = tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()))
        entries[key] = [int(rng.integers(0, 3)), int(rng.integers(1, 4)), str(len(entries))]
    index = toxicity.BlockMaxIndex(entries, rng.uniform(1, 5, 40))
    for _ in range(50):
        query = tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()))
        at, cosines = index.nearest(query)
        every = np.zeros(len(entries))
        for k, key in enumerate(sorted(entries)):
            own = dict(zip(key, index.unit(key)))
            every[k] = sum(own.get(f, 0) * q for f, q in zip(query, index.unit(query)))
        order = np.lexsort((np.arange(len(every)), -every))
        held = int(np.searchsorted(np.cumsum(index.count[order]), toxicity.NEAREST))
        reach = every[order][min(held, len(order) - 1)]
        expected = {k for k in range(len(every)) if every[k] >= max(reach, 0) - 1e-12 and every[k] > 0}
        assert set(at.tolist()) == expected and np.allclose(cosines, every[at])


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\n", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n\r\n"),
             (6, "u", "é" * 100_000), (None, "u", "lone"), (2, "again", "<p>x</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(frame, str(tmp_path / "w"))
    out = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert not [r for r in out if r["kind"] == "gap"] and len(out) == len(pages)
    kinds = Counter((r["record_id"], r["kind"], r["refers_to"]) for r in out)
    page = "<urn:page:{}>".format
    assert kinds[page(1), "revisit", page(2)] == 1 and kinds[page(2), "response", None] == 2
    assert kinds[page(3), "revisit", page(4)] == 1 and kinds[page(""), "response", None] == 1
    payloads = {r["record_id"]: bytes(r["payload"]) for r in out if r["kind"] == "response"}
    assert payloads[page(6)] == ("é" * 100_000).encode() and payloads[page(5)] == b"WARC/1.1\r\n\r\n\r\n"
    assert all(r["payload_digest"] == warc.digest(bytes(r["payload"])) for r in out if r["kind"] == "response")


def test_salvage():
    import gzip

    parts = [warc.record(k, "u", f"page {k}".encode() * 50) + warc.END for k in range(6)]
    plain = b"".join(parts)
    found = list(warc.records(plain))
    assert [x.header["warc-record-id"] for x in found] == [f"<urn:page:{k}>" for k in range(6)]
    # A changed byte, a cut and foreign bytes lose only the records they touch.
    broken = parts[0] + parts[1].replace(b"page 1page", b"page 1pagf", 1) + b"junk" + parts[2] + parts[3][:100] + parts[4]
    found = list(warc.records(broken))
    assert [x.header["warc-record-id"][10:-1] for x in found if x.kind != "gap"] == ["0", "2", "4"]
    gaps = [(x.start, x.end) for x in found if x.kind == "gap"]
    at = len(parts[0]), len(parts[0]) + len(parts[1]) + 4
    assert gaps[0] == at and all(x.reason for x in found if x.kind == "gap")
    members = [gzip.compress(x) for x in parts]
    bad = bytearray(members[2])
    bad[len(bad) // 2] ^= 0xFF
    stream = members[0] + members[1] + bytes(bad) + b"??" + members[3] + members[4][:-20]
    good = [x.header["warc-record-id"][10:-1] for x in warc.records(stream) if x.kind == "response"]
    assert good[:2] == ["0", "1"] and "3" in good and "2" not in good
    assert list(warc.records(b"")) == [] and [x.kind for x in warc.records(b"no archive")] == ["gap"]


def _ids(data):
    return [x.header["warc-record-id"][10:-1] for x in warc.records(data) if x.kind != "gap"]


def test_salvage_of_damaged_heads_and_mixed_archives():
    import gzip

    rng = random.Random(8)
    parts = [warc.record(k, "u", rng.randbytes(6_000).hex().encode()) + warc.END for k in range(6)]
    members = [gzip.compress(x) for x in parts]
    whole = b"".join(members)
    assert len(members[0]) < 10_000 < len(members[0]) + len(members[1])
    assert _ids(rng.randbytes(10_000) + whole[10_000:]) == ["2", "3", "4", "5"]
    assert _ids(bytes(10_000) + whole[10_000:]) == ["2", "3", "4", "5"]
    # A plain record with a gzip payload in the first bytes of the archive.
    packed = warc.record(9, "u", gzip.compress(b"page" * 100)) + warc.END
    found = list(warc.records(packed + parts[0] + parts[1]))
    assert [x.kind for x in found] == ["response"] * 3 and gzip.decompress(found[0].payload) == b"page" * 100
    assert _ids(packed[:300] + packed + parts[0]) == ["9", "0"]
    # Members and plain records in one archive, one member damaged.
    cut = members[2][:4_000]
    assert _ids(members[0] + parts[1] + cut + parts[3] + b"junk" + members[4] + parts[5]) == ["0", "1", "3", "4", "5"]
    # A member that stores its bytes gives each record once.
    stored = bytearray(gzip.compress(b"".join(parts[:3]), 0))
    stored[-5] ^= 1
    assert sorted(_ids(bytes(stored) + members[0])) == ["0", "0", "1", "2"]


def test_salvage_within_a_member_of_many_records():
    import gzip

    rng = random.Random(6)
    # The stream is 3 KB in the first case, and several steps of the decoder in the second.
    for size, n in ((20, 40), (6_000, 40)):
        parts = [warc.record(k, "u", rng.randbytes(size).hex().encode()) + warc.END for k in range(n)]
        member = gzip.compress(b"".join(parts))
        trailer = bytearray(member)
        trailer[-6] ^= 0xFF
        after = gzip.compress(warc.record(99, "u", b"after") + warc.END)
        assert _ids(bytes(trailer) + after) == [*map(str, range(n)), "99"]
        middle = bytearray(member)
        middle[len(middle) // 2 : len(middle) // 2 + 8] = b"\xff" * 8
        found = _ids(bytes(middle) + after)
        assert found[-1] == "99" and found[:-1][: n // 2 - 3] == [str(k) for k in range(n // 2 - 3)]


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 48))
    vectors = [*base, *(base[:30] + rng.normal(size=(30, 48)) * 0.15), *base[:5] * 3.0, *base[:5], base[0], -base[1]]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 48, [1.0, None] * 24, [float("nan")] * 48, [float("inf")] + [1.0] * 47, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + k, v, None) for k, v in enumerate(odd)] + [(None, rows[7][1], 1)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int")).collect()
    fine = [k for k, (_, v, _) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = {k: set() for k in range(len(rows))}
    for a in fine:
        for b in fine:
            x, y = np.array(rows[a][1]), np.array(rows[b][1])
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links[a].add(b)
    got = {r["vec_id"]: r for r in out if r["vec_id"] is not None}
    found = sum(got[k]["n_links"] for k in range(len(vectors)))
    true = sum(len(links[k]) for k in range(len(vectors)))
    assert all(got[k]["n_links"] <= len(links[k]) for k in range(len(vectors))) and found >= 0.98 * true
    for k in range(1000, 1006):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert got[1006]["n_links"] == 1 and got[1007]["component_id"] == 1006
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = raw.withColumn("score", F.lit("mine")).withColumn("kept", F.lit(7)).withColumn("spans", F.lit(None).cast("string"))
    odd = extra.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"),
                                *[F.col(c) for c in extra.columns[2:]])
    docs, kept = extra.union(odd).union(extra.where("doc_id = 1")), []
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns and out.where("score <> 'mine' or kept <> 7").count() == 0
        kept.append({r["doc_id"]: r["text"] for r in out.collect()})
        docs = out
    before = {r["doc_id"]: r["text"] for r in raw.collect()}
    assert None in kept[3] and docs.where("doc_id = 1").count() <= 1
    # Each stage against brute force on what the one before kept.
    shingles = lambda t, w: {tuple(t[i : i + w]) for i in range(max(1, len(t) - w + 1))} if t else set()
    sets = {i: shingles(WORD.findall(lowered(t)), 5) for i, t in kept[0].items() if i is not None}
    same = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)
    pairs = list(sets.items())
    group = brute_components(pairs, same)
    assert {i for i in kept[1] if i is not None} == {i for (i, s), c in zip(pairs, group) if i == c}
    items = [shingles(WORD.findall(lowered(r["text"])), 5) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i in kept[1] if i is not None and any(len(sets[i] & x) >= 0.8 * len(x) for x in items)}
    assert set(kept[2]) == set(kept[1]) - leaks and leaks
    assert set(kept[3]) == set(kept[2])
    for i, text in kept[3].items():
        assert (text == before.get(i)) == (not secrets.find(before.get(i) or ""))
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
