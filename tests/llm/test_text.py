"""Chat formatting, byte-level BPE, URL filter, quality rules, mixing and the classifiers."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.test_dedup import reach
from tidemark.llm import bpe, chat, language, mixing, quality_model, quality_rules, subword, url_filter
from tidemark.llm.subword import Settings, document_features, sample_features

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# chat


def test_chat_round_trip(spark):
    rng = random.Random(5)
    tricky = ["", None, "\\", "### assistant: x </turn>\n", "a\\:b#c<d", "</turn>", "\n### user: ", "é😀:\\\\"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "as:sist#ant", None]), rng.choice(tricky)) for c in range(30) for t in range(rng.randrange(1, 6))]
    formatted = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    parts = chat.examples(formatted)
    found = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    examples = {}
    for r in chat.expand(parts).collect():
        examples.setdefault(r["conv_id"], []).append(r)
    for conv, row in found.items():
        turns = sorted(((t, role, text) for c, t, role, text in rows if c == conv), key=lambda x: x[0])
        turns = [(role or "", text or "") for _, role, text in turns]
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        replies = [text for role, text in turns if role == "assistant"]
        assert row["loss_sha256"] == hashlib.sha256("".join(replies).encode()).hexdigest() and row["loss_chars"] == len("".join(replies))
        own = sorted(examples.get(conv, []), key=lambda r: r["example"])
        assert [chat.unescape(r["text"][r["loss_start"] : r["loss_end"]]) for r in own] == replies
        assert sum(len(r["text"]) for r in own) == row["formatted_chars"]
        for r in own:  # all turns before the reply, and only those, are its context
            context = r["text"][: r["loss_start"]]
            assert chat.parse(context[: context.rfind("### ")]) == turns[: r["example"]]


def test_chat_ties_and_empty_tables(spark):
    rows = [(1, 0, "user", "b", "x"), (1, 0, "user", "a", "y"), (1, 0, "user", "a", "y"), (None, None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    found = {r["conv_id"]: r["n_turns"] for r in chat.read_back(chat.examples(chat.format_turns(turns))).collect()}
    assert found == {1: 3, None: 1}
    nothing = chat.examples(chat.format_turns(turns.limit(0)))
    assert chat.read_back(nothing).count() == 0 and chat.expand(nothing).count() == 0
    with pytest.raises(ValueError):
        chat.parse("### user: a </turn>\nrest")


def test_chat_escaping_is_needed(spark, monkeypatch):
    """Markers inside a text would be read as turns of their own if they were not escaped."""
    rows = [(1, 0, "user", "a </turn>\n### user: b"), (1, 1, "assistant", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()
    assert [(r["n_turns"], r["turns_sha256"]) for r in chat.read_back(chat.examples(chat.format_turns(turns))).collect()] == [(2, whole)]
    monkeypatch.setattr(chat, "escape", lambda text: F.coalesce(text, F.lit("")))
    plain = chat.read_back(chat.examples(chat.format_turns(turns))).collect()
    assert [r["n_turns"] for r in plain] == [3] and plain[0]["turns_sha256"] != whole
    broken = turns.unionByName(spark.createDataFrame([(2, 0, "assistant", "x </turn>\n y")], turns.schema))
    with pytest.raises(Exception, match="no (turn|reply)"):
        chat.read_back(chat.examples(chat.format_turns(broken))).collect()


def test_chat_masks_are_held_against_the_reply(spark):
    parts = chat.examples(chat.format_turns(spark.createDataFrame([(1, 0, "assistant", "abc")], "conv_id long, turn long, role string, text string")))
    with pytest.raises(Exception, match="mask"):
        chat.read_back(parts.withColumn("loss_end", F.col("loss_end") - 1)).collect()


def test_a_very_long_conversation_is_a_stream_of_parts(spark):
    """2,000 turns of one conversation, one of them of a million characters; parts add up to the length once."""
    turns = spark.range(2000).selectExpr("7L AS conv_id", "id AS turn", "CASE WHEN id % 3 = 2 THEN 'assistant' ELSE 'user' END AS role",
                                         "CASE WHEN id = 1000 THEN repeat('x<', 1000000) ELSE concat('# ', id) END AS text", "'x' AS example")
    formatted = chat.format_turns(turns)
    parts = chat.examples(formatted)
    (row,) = chat.read_back(parts).collect()
    assert row["n_turns"] == 2000 and row["loss_sha256"] == hashlib.sha256("".join(f"# {i}" for i in range(2, 2000, 3)).encode()).hexdigest()
    total = formatted.selectExpr("sum(length(segment))").first()[0]
    sizes = [len(r["text"]) for r in parts.collect()]
    assert sum(sizes) == total and len(sizes) > 666
    batch = parts.orderBy("part").toArrow()
    cut = next(chat._read_back(iter(batch.select(["conv_id", "example", "text", "loss_start", "loss_end"]).to_batches(max_chunksize=5))))
    assert cut.column(2).to_pylist() == [row["turns_sha256"]]


def test_every_assistant_turn_has_its_whole_prefix(spark, sf, monkeypatch):
    """One row for each assistant turn, whose text is the prefix and the target; op2 reads these."""
    rows = [(c, t, "assistant" if t % 2 else "user", f"say: {c} {t}" * (c + 1)) for c in range(5) for t in range(2 * c + 1)]
    formatted = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = {(r["conv_id"], r["example"]): (r["text"], r["loss_start"], r["loss_end"]) for r in chat.expand(chat.examples(formatted)).collect()}
    whole = chat.expanded(formatted)
    got = {(r["conv_id"], r["example"]): (r["text"], r["loss_start"], r["loss_end"]) for r in whole.where("example IS NOT NULL").collect()}
    assert got == want and len(got) == sum(t % 2 for _, t, _, _ in rows)
    digests = sorted(map(tuple, chat.read_back(whole).collect()))
    for form in (chat.examples(formatted), chat.expanded(formatted, 150)):  # longer examples go on as parts
        assert sorted(map(tuple, chat.read_back(form).collect())) == digests
    cut = {r["start"] > 0 for r in chat.expanded(formatted, 150).where("example IS NOT NULL").collect()}
    assert cut == {True, False}
    seen = []
    monkeypatch.setattr(chat, "read_back", lambda parts: seen.append(parts) or parts)
    chat.op2_chat_format(spark, sf)
    assert seen[0].where("example IS NOT NULL AND (start <> 0 OR char_length(text) <> loss_end)").count() == 0
    assert seen[0].where("example IS NOT NULL").count() > 10


def test_an_example_whose_prefix_differs_is_rejected(spark):
    rows = [(1, 0, "user", "abc"), (1, 1, "assistant", "d"), (1, 2, "user", "e"), (1, 3, "assistant", "f")]
    whole = chat.expanded(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert [r["n_turns"] for r in chat.read_back(whole).collect()] == [4]
    with pytest.raises(Exception, match="does not begin with"):
        chat.read_back(whole.withColumn("text", F.when(F.col("example") == 3, F.replace("text", F.lit("abc"), F.lit("abx"))).otherwise(F.col("text")))).collect()


# byte-level BPE


def test_bpe_equals_tiktoken(spark):
    rng = random.Random(6)
    alphabet = "abcdefghij  \n\t'.,0123456789éß漢字😀‍\x00\xa0"
    texts = ["", None, " ", "a" * 3000, "ab" * 700, " " * 900, "<|endoftext|>", "\r\n\r\n  x", "'s 't I'LL", "word " * 4000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: list(r["ids"]) for r in encoded.collect()} == want
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(encoded, RANKS).collect()} == {i: t or "" for i, t in enumerate(texts)}
    for r in bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def whole_pieces():
    """The library with every text as one piece."""
    return tiktoken.Encoding("x", pat_str=r"(?s).+", mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_pieces_by_both_queries():
    """Both recursive queries give the library's ids, also where contractions give rise to pairs of lower rank."""
    encoder, library, rng = bpe.Encoder(bpe.read_ranks(RANKS)), whole_pieces(), random.Random(7)
    pieces = {"".join(rng.choice(a) for _ in range(rng.randrange(1, 120))) for a in ("abé-=_", "the in", "aab", "etaoin") for _ in range(25)}
    encoder.learn(pieces)
    for piece in pieces:
        want = np.array(library.encode_ordinary(piece), "<u4").tobytes()
        assert encoder.known[piece] == want and encoder._long(piece.encode()) == want


@pytest.mark.parametrize("rows", [500_000, 20_000])
def test_bpe_long_pieces(monkeypatch, rows):
    """Pieces of 5,000 bytes and more; with few rows allowed a query takes up where the one before stopped."""
    monkeypatch.setattr(bpe, "QUERY_ROWS", rows)
    encoder, library, rng = bpe.Encoder(bpe.read_ranks(RANKS)), whole_pieces(), random.Random(8)
    pieces = ["a" * 5000, "ab" * 2501, "=" * 100_001, "\u6f22\u5b57" * 900, "".join(rng.choice("etaoinshrdlu") for _ in range(5000))]
    encoder.learn({*pieces})
    for piece in pieces:
        assert encoder.known[piece] == np.array(library.encode_ordinary(piece), "<u4").tobytes()


def test_bpe_text_of_50_mb():
    """A text of 50 MB is read and decoded in slices; 12 million tokens."""
    import regex

    text = "The quick brown fox, jumps over 13 lazy dogs; caf\u00e9!\n" * 1_000_000
    ranks = bpe.read_ranks(RANKS)
    (ids,) = bpe._encode_texts([text], regex.compile(public_tokenizers.PATTERN), bpe.Encoder(ranks))
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(text.encode()) > 50e6 and ids == np.array(library.encode_ordinary(text), "<u4").tobytes()
    lists = pa.ListArray.from_arrays(pa.array([0, 0, len(ids) // 4], pa.int32()), pa.array(np.frombuffer(ids, "<i4")))
    digest, parts = hashlib.sha256(), 0
    for row, data in bpe.Decoder(ranks).parts(lists):
        assert row == 1
        digest.update(data)
        parts += 1
    assert parts > 50 and digest.digest() == hashlib.sha256(text.encode()).digest()


def test_bpe_edges(spark):
    docs = spark.createDataFrame([(None, "a", "x"), (1, "a", "y"), (1, "a", "y")], "doc_id long, text string, ids string")
    assert bpe.encode(docs, RANKS, public_tokenizers.PATTERN).count() == 3
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    bad = spark.createDataFrame([(1, [10**6], "")], "doc_id long, ids array<int>, ids_sha256 string")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(bad, RANKS).collect()


# URL filter


def test_redirects_and_canonical_links_carry_decisions(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "https://a.net/x", None), (2, "http://mirror.io/p", link("https://a.net/x")), (3, "http://far.io/q", link("http://mirror.io/p")),
        (4, "https://sub.Example.NET/en/1", link("http://alias.io/")), (5, "http://alias.io/", link("https://b.net/y")), (6, "http://clean.io/", "<p>"),
        (7, None, link("https://a.net/x")), (8, "no scheme", None), (9, "https://example.com/de/x?q=://z", None), (10, "http://notnet/", None), (11, "http://NET/", None),
        (12, "http://old.io/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://old.io/", "/new"), ("http://old.io/new", "https://a.net/x"), (None, "http://x.io/")], "from_url string, to_url string")
    found = {r["page_id"]: r for r in url_filter.judge(pages, moved).collect()}
    blocked = {p for p, r in found.items() if r["verdict"] == "block"}
    assert blocked == {1, 2, 3, 9, 11, 12}
    assert found[4]["rule"] == "example.net/en/" and found[5]["verdict"] == "allow" and found[5]["rule"] is None
    assert (found[7]["host"], found[7]["path"], found[8]["host"]) == ("", "", "") and found[9]["path"] == "/de/x"
    assert url_filter.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, moved, ()).collect()} == {"allow"}


def brute_verdicts(pages, moved, rules):
    """Verdicts by plain loops: the longest rule of a page, else allow before block over all that is linked."""
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        return re.split(r"[/?#]", rest, maxsplit=1)[0].lower(), re.split(r"[?#]", rest[len(re.split(r"[/?#]", rest, maxsplit=1)[0]) :], maxsplit=1)[0]

    def own(url):
        host, path = parts(url)
        fits = [(len(h) + len(p), len(h), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[3:] if fits else None

    def name(url):
        return "".join((parts(url)[0], parts(url)[1] or "/"))

    links = [(name(u), name(t)) for _, u, targets in pages for t in targets] + [(name(a), name(b)) for a, b in moved]
    urls = {name(u) for u in [*[u for _, u, _ in pages], *[t for _, _, ts in pages for t in ts], *[u for m in moved for u in m]]}
    least = reach(urls, links)
    groups = {}
    for n in {n for link in links if link[0] != link[1] for n in link}:  # a URL without links has no aliases, not even itself
        if mine := own("http://" + n):
            groups.setdefault(least[n], set()).add(mine[1])
    found = {}
    for page, url, _ in pages:
        mine, group = own(url), groups.get(least[name(url)], set())
        found[page] = mine or (None, "allow" if "allow" in group or not group else "block")
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_random_link_graphs_equal_brute_force(spark, seed):
    """Chains, cycles, stars and pages that come twice, with rules for hosts, subdomains and paths."""
    rng = random.Random(seed)
    urls = [f"http://{rng.choice(['', 'a.', 'b.a.'])}s{rng.randrange(60)}.{rng.choice(['com', 'net', 'org'])}{rng.choice(['', '/', '/x', '/x/y', '/de/1'])}" for _ in range(220)]
    rules = [("block", "net", "/"), ("allow", "a.s7.net", "/x"), ("block", "s9.com", "/x/"), ("block", "s9.com", "/"), ("allow", "s9.com", "/"), ("allow", "b.a.s9.com", "/x")]
    rules += [(rng.choice(["allow", "block"]), f"s{rng.randrange(60)}.{rng.choice(['com', 'org'])}", rng.choice(["/", "/x", "/de/"])) for _ in range(12)]
    pages = [(i, rng.choice(urls), [rng.choice(urls)] if rng.random() < 0.4 else []) for i in range(300)]
    moved = [(a, b) for a, b in zip(urls[:30], urls[1:31], strict=True)] + [(urls[30], urls[5])] + [(urls[40], u) for u in urls[41:60]]
    rows = [(i, u, "".join(f'<link rel="canonical" href="{t}">' for t in ts), "x", "y") for i, u, ts in pages]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")
    frame = frame.union(frame.limit(20))
    judged = url_filter.judge(frame, spark.createDataFrame(moved, "from_url string, to_url string"), tuple(rules)).collect()
    assert len(judged) == 320 and {r["page_id"]: (r["rule"], r["verdict"]) for r in judged} == brute_verdicts(pages, moved, rules)
    assert len({r["verdict"] for r in judged if r["rule"] is None}) == 2


def test_a_hundred_thousand_rules_and_odd_urls(spark):
    rules = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'allow' ELSE 'block' END AS verdict", "concat('h', id % 1000, '.com') AS host", "concat('/', id DIV 1000, '/') AS path")
    rows = [(i, f"http://{'w.' * (i % 3)}h{i}.com/{i % 120}/p", "<p>" * 100_000 if i == 5 else "") for i in range(1000)]
    rows += [(2000, "http://" + "." * 50_000 + "h1.com/1/", None), (2001, None, None), (2002, "http:///1/", None), (2003, "http://h1.com", None)]
    found = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules=rules).collect()}
    for i in range(1000):
        p = i % 120
        assert found[i]["rule"] == (f"h{i}.com/{p}/" if p < 100 else None) and found[i]["verdict"] == ("block" if p < 100 and (p * 1000 + i) % 3 else "allow")
    assert found[2000]["rule"] == "h1.com/1/" and [found[i]["rule"] for i in (2001, 2002, 2003)] == [None] * 3


def test_every_link_of_a_page_is_an_alias(spark):
    link, refresh = '<link rel={} href="{}">'.format, '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "http://a.io/", link("canonical", "http://a.io/1") + "<p>" + link('"canonical"', "https://x.net/")),
        (2, "http://b.io/", refresh("/1") + refresh("https://y.net/")),
        (3, "http://c.io/", link('"shortlink canonical"', "https://z.net/")),
        (4, "http://d.io/", link("'shortlink\ncanonical'", "https://z.net/")),
        (5, "http://e.io/", link('"alternate" title="canonical"', "https://z.net/") + link('"noncanonical"', "https://z.net/")),
        (6, "http://a.io/1", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block"}


# quality rules


def brute_base(text):
    words = [w for w in (text or "").encode().split()]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), len(b"".join(words).decode()), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_base_columns_equal_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\n ", "a b c a b c", "a a a a a", "x\n" * 20, "é\xa0b c d " * 5, "# $ % !!!!", "a b c\na b c\n\n a b c"]
    texts += [rng.choice([" ", "\n"]).join(rng.choice("abc*é") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = quality_rules.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in found} == {i: brute_base(t) for i, t in enumerate(texts)}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in found)


def test_filters_on_figures_compute_them_once(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20), (2, None)], "doc_id long, text string")
    plan = quality_rules.judge(docs).where("kept AND n_repeat_words < 9 AND n_words > 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == 2  # of windows and of lines


def test_order_of_rules_changes_no_verdict(spark):
    rules = quality_rules.rules()
    docs = spark.createDataFrame([(i, " ".join(f"word{j}" for j in range(60)) + x) for i, x in enumerate(["", " #" * 300, "!!" * 200, " 1 2 3" * 60])], "doc_id long, text string")
    base = quality_rules.base_columns(docs)
    kept = [{r["doc_id"] for r in base.where(quality_rules.cascade(order).isNull()).collect()} for order in (rules, rules[::-1])]
    assert kept[0] == kept[1] and 0 in kept[0] and 1 not in kept[0]
    assert {r.name for r in quality_rules.ordered(base, rules)} == {r.name for r in rules}
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))
    assert quality_rules.judge(clash).count() == 4 and quality_rules.judge(docs.limit(0)).count() == 0


def test_rules_are_ordered_by_rejections_per_cost(spark):
    """A rule that rejects most but is slow comes last, in each of three runs; what the base conditions reject does not count."""
    texts = ["# " * 60 if i % 4 == 0 else " ".join(f"word{j}" for j in range(i, i + 60)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    slow = quality_rules.Rule("a_slow", F.regexp_count(F.repeat("_text", 20), F.lit(r"(\w+)\d ")) >= 0)
    some = quality_rules.Rule("some", F.col("n_words") + F.col("doc_id") % 3 > 61)
    none = quality_rules.Rule("none", F.col("n_symbols") > 50)  # only documents that the base conditions reject
    for _ in range(3):
        base = quality_rules.sampled(docs)
        assert [r.name for r in quality_rules.ordered(base, [slow, none, some])] == ["some", "a_slow", "none"]
        cost, rejected = quality_rules.costs(base, [slow, some, none])
        assert cost["a_slow"] > 3 * cost["some"] and rejected == {"a_slow": 150, "some": 50, "none": 0}
    assert [r.name for r in quality_rules.ordered(base.limit(0), [slow, none, some])] == ["a_slow", "none", "some"]


def test_sample_of_quality_rules(spark):
    docs = spark.range(50_000).selectExpr("id AS doc_id", "'a b' AS text")
    assert 500 <= quality_rules.sampled(docs).count() <= 2 * quality_rules.SAMPLE_ROWS
    for odd in (docs.withColumn("doc_id", F.lit(None).cast("long")), docs.withColumn("doc_id", F.when(F.col("doc_id") > 9, 10**12).otherwise(0))):
        assert 500 <= quality_rules.sampled(odd).count() <= 2 * quality_rules.SAMPLE_ROWS
    assert quality_rules.sampled(docs.limit(0)).count() == 0


def test_quality_of_very_long_and_repeated_texts(spark):
    texts = [" ".join(f"w{i}" for i in range(300_000)), "a b c " * 100_000, "x" * 2_000_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(2, texts[2])], "doc_id long, text string")
    found = sorted((r["doc_id"], r["n_words"], r["n_repeat_words"], r["kept"]) for r in quality_rules.judge(docs).collect())
    assert found == [(0, 300_000, 0, True), (1, 300_000, 300_000, False), (2, 1, 0, False), (2, 1, 0, False)]


# mixing


def brute_targets(sizes):
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes, key=lambda k: (k is None, k)))}
    left, target, open_ = float(sum(sizes.values())), {}, dict(weight)
    while open_:
        share = left / sum(open_.values())
        full = [k for k in open_ if share * weight[k] >= 3 * sizes[k]]
        if not full:
            return target | {k: share * w for k, w in open_.items()}
        for k in full:
            target[k] = 3.0 * sizes[k]
            left -= target[k]
            del open_[k]
    return target


def test_mixing_meets_targets(spark):
    rng = random.Random(10)
    sources = ["b", "a", "Z", None, "~", "é", "none"]
    rows = [(i, rng.choices(sources, [1, 30, 3, 2, 1, 10, 1])[0], "w " * rng.randrange(0, 60)) for i in range(400)] + [(None, "b", "x y"), (3, "a", None), (3, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    keyed = mixing._keyed(docs)
    placed = mixing._place(keyed, keyed.select("_key", "_order", "_size")).collect()
    assert len(placed) == len(rows)
    for source, target in want.items():
        own = [r for r in placed if r["source"] == source]
        assert all(r["target"] == pytest.approx(target) and 0 <= r["_taken"] <= 3 * r["_size"] for r in own)
        assert sum(r["_taken"] for r in own) == pytest.approx(target, abs=2)


def test_curriculum_positions(spark):
    """Positions grow with demand, and the inverse undoes the integral."""
    df = spark.range(1, 100).select((F.col("id") / 100).alias("s")).select("s", *[mixing.position(F.col("s"), F.lit(t)).alias(f"t{i}") for i, t in enumerate((-0.8, 0.0, 0.8))])
    for r in df.collect():
        for name, tilt in (("t0", -0.8), ("t1", 0.0), ("t2", 0.8)):
            x = r[name]
            assert 0 <= x <= 1 and x + tilt * (x * x - x) == pytest.approx(r["s"])


def test_mix_writes_documents_in_order(spark):
    docs = spark.createDataFrame([(i, "a" if i % 4 else "b", f"d{i} " * 10, i) for i in range(40)], "doc_id long, source string, text string, words int")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = {s: sum(len(r["text"].split()) for r in mixed.collect() if r["source"] == s) for s in "ab"}
    assert taken["a"] == pytest.approx(400 * 5 / 7, abs=1) and taken["b"] == pytest.approx(400 * 2 / 7, abs=1)
    assert mixing.mix(docs).collect() == mixed.collect()
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_of_ties_and_clashing_names(spark):
    """One id with several texts of one size, and columns named like the operator's own."""
    rows = [(7, "a", f"t{i} x y z", i, "s") for i in range(8)] + [(None, "b", "w " * 9, 9, None), (8, "b", "w " * 30, 10, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, taken string")
    first = [tuple(r) for r in mixing.mix(docs.repartition(3)).collect()]
    assert first == [tuple(r) for r in mixing.mix(docs.repartition(5, "size")).collect()]
    assert mixing.mix(docs).columns == docs.columns and {r[4] for r in first} <= {"s", "t", None}


# classifiers


def plain_features(text, buckets):
    """Weights by feature, one word and one character at a time."""
    mask = 2**64 - 1
    prime, mix = 0x100000001B3, 0x9E3779B97F4A7C15

    def mixed(x):
        x = ((x ^ (x >> 32)) * mix) & mask
        return x ^ (x >> 29)

    words, weights, hashes = (text or "").split(), {}, []
    for word in words:
        codes = [ord(c) + 1 for c in f"<{word}>"]
        hashes.append(mixed(sum(c * pow(prime, i + 1, 2**64) for i, c in enumerate(codes)) & mask))
        ids = [hashes[-1] % buckets]
        for n in (3, 4, 5):
            for i in range(len(codes) - n + 1):
                h = n
                for c in codes[i : i + n]:
                    h = (h * prime + c) & mask
                ids.append(mixed(h) % buckets)
        for f in ids:
            weights[f] = weights.get(f, 0) + 1 / len(ids)
    for a, b in zip(hashes, hashes[1:], strict=False):
        f = (mix if a == b else mixed((a * prime + b) & mask)) % buckets
        weights[f] = weights.get(f, 0) + 1
    return {f: w / max(1, 2 * len(words) - 1) for f, w in weights.items()}


ODD_TEXTS = [None, "", " \n", "a", "the cat the cat sat", "\u00e9t\u00e9 \U0001f600 x\x00y", "go go go go", "z" * 200, "one two three " * 40]


@pytest.mark.parametrize("chars", [1 << 15, 32])
def test_features_and_means_equal_a_plain_version(monkeypatch, chars):
    """Features of documents, and the means that tasks compute, also where words and texts are taken in portions."""
    monkeypatch.setattr(subword, "WORD_CHARS", chars)
    monkeypatch.setattr(subword, "TEXT_CHARS", chars)
    monkeypatch.setattr(subword, "REMEMBERED", 8)
    buckets = 1 << 10
    settings = Settings(buckets=buckets, dim=4)
    model = subword.train([], ["x", "y"], settings)
    model.vectors = np.random.default_rng(1).normal(size=(buckets, 4)).astype(np.float32)
    means = subword.Scorer(model).means(ODD_TEXTS + ODD_TEXTS)
    for n, text in enumerate(ODD_TEXTS):
        want = plain_features(text, buckets)
        ids, share = document_features(text, buckets)
        assert sorted(want) == ids.tolist() and share == pytest.approx([want[i] for i in ids.tolist()], abs=1e-6)
        mean = sum((w * model.vectors[f].astype(float) for f, w in want.items()), np.zeros(4))
        assert means[n] == pytest.approx(mean, abs=1e-5) and means[n + len(ODD_TEXTS)] == pytest.approx(mean, abs=1e-5)


def test_training_is_gradient_descent_and_the_threshold_a_quantile():
    """One pass over three documents against plain loops; then the temperature of least loss and the rejection threshold."""
    settings = Settings(buckets=64, dim=3, epochs=1, steps=1, rate=0.5)
    rows = [(n % 2, *document_features(t, 64)) for n, t in enumerate(["a b", "c d e", "a c"])]
    model = subword.train(rows, ["x", "y"], settings)
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / 3, 1 / 3, (64, 3)).astype(np.float32).astype(float)
    weights = np.zeros((2, 4))
    for done, n in enumerate(rng.permutation(3)):
        label, ids, share = rows[n]
        rate = 0.5 * (1 - done / 3)
        mean = [*(sum(s * vectors[i][k] for i, s in zip(ids, share, strict=True)) for k in range(3)), 1.0]
        logits = [sum(w * m for w, m in zip(row, mean, strict=True)) for row in weights]
        p = np.exp(logits) / sum(np.exp(logits))
        p[label] -= 1
        back = [sum(p[c] * weights[c][k] for c in range(2)) for k in range(3)]
        for c in range(2):
            weights[c] -= rate * p[c] * np.array(mean)
        for i, s in zip(ids, share, strict=True):
            vectors[i] -= rate * 4 * s * np.array(back)
    assert model.vectors == pytest.approx(vectors, abs=1e-5) and model.weights == pytest.approx(weights, abs=1e-5)
    subword.calibrate(model, rows)
    losses = {}
    for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0):
        logits = (subword.means(model, rows) @ model.weights[:, :-1].T + model.weights[:, -1]) / t
        p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
        losses[t] = -np.log([p[n][r[0]] for n, r in enumerate(rows)]).mean()
    assert model.temperature == min(losses, key=losses.get)
    p = model.probabilities(subword.means(model, rows))
    right = [max(p[n]) for n, r in enumerate(rows) if p[n].argmax() == r[0]]
    assert model.threshold == pytest.approx(min(0.5, np.quantile(right, 0.001)), abs=1e-6)


def test_classifiers_take_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(i % 30, f"word{i % 30} {'good' if i % 2 else 'bad'}", "en", i, "x", 0.5) for i in range(60)] + [(None, "z", None, 0, None, None)], "doc_id long, text string, lang string, label int, _text string, score double")
    labels = spark.createDataFrame([(i % 30, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels, Settings(buckets=1 << 10, steps=500))
    found = quality_model.classify(docs, model)
    assert found.count() == 61 and found.columns == ["doc_id", "held_out", "score", "predicted"]
    named = language.identify(docs, language.fit(docs, Settings(buckets=1 << 10, steps=500)))
    assert named.count() == 61 and {r["_lang_pred"] for r in named.collect()} == {"en"}


def test_sample_is_the_least_hashes_of_each_class_and_bounded(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('w', id) AS text").union(spark.range(500).selectExpr("-1L", "concat('x', id % 3)"))
    labelled = docs.selectExpr("doc_id", "CASE WHEN doc_id = -1 THEN 'hot' WHEN doc_id < 7 THEN 'tiny' ELSE 'big' END AS label")
    labels, rows = sample_features(docs, labelled, Settings(per_class=20))
    found = {name: sorted(r[1].tolist() for r in rows if labels[r[0]] == name) for name in labels}
    assert {k: len(v) for k, v in found.items()} == {"big": 20, "hot": 1, "tiny": 7}
    least = labelled.where("label = 'big'").distinct().orderBy(F.xxhash64("doc_id")).limit(20).collect()
    assert found["big"] == sorted(document_features(f"w{r['doc_id']}", Settings.buckets)[0].tolist() for r in least)
    assert sample_features(docs.limit(0), labelled.limit(0), Settings()) == ([], [])


def test_language_is_learned_from_text_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r["doc_id"]: r for r in language.op8_language_id(spark, sf).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in found if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(found[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in found)
    known = [d for d in held if truth[d] is not None and found[d]["lang_pred"] != "und"]
    assert sum(found[d]["lang_pred"] == truth[d] for d in known) >= 0.9 * len(known)


def test_language_edges(spark):
    rows = [(i, t, g) for i in range(40) for t, g in ((f"the cat and the dog {i}", "en"), (f"der hund und die katze {i}", "de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, language.Settings(buckets=1 << 12, steps=2000))
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 !!", "x"), (4, "the dog", None), (None, "die katze", "y")], "doc_id long, text string, label string")
    found = [(r["doc_id"], r["_lang_pred"], r["_score"]) for r in language.identify(odd, model).collect()]
    assert [x[:2] for x in found] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de")]
    assert all(0 <= s <= 1 for _, _, s in found)
    untrained = language.fit(docs.where("lang IS NULL"))
    assert {r["_lang_pred"] for r in language.identify(odd, untrained).collect()} == {"und"}
    assert language.identify(odd.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = {r["doc_id"]: r for r in quality_model.op6_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.values())
    held = [d for d in labels if d in found and zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(found[d]["held_out"] for d in held)
    good, bad = ([found[d]["score"] for d in held if labels[d] == q] for q in (1, 0))
    area = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert area >= 0.85


def test_a_model_is_learned_in_a_task_as_it_would_be_on_the_driver(spark, sf):
    """The driver gets the model alone: its memory does not grow by the sample."""
    import os

    settings = Settings(buckets=1 << 10, steps=300, per_class=30)
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "lang AS label")
    known = docs.where("label IS NOT NULL")

    def fit(labels, rows):
        model = subword.train(rows, labels, settings)
        model.where = os.getpid()
        return model

    here, there = fit(*sample_features(docs, known, settings)), subword.learned(docs, known, settings, fit)
    assert there.labels == here.labels and np.array_equal(there.vectors, here.vectors) and np.array_equal(there.weights, here.weights)
    assert here.where == os.getpid() != there.where
    assert subword.learned(docs.limit(0), known.limit(0), settings, fit).labels == []
    places = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language, "calibrate", lambda model, rows: setattr(model, "where", os.getpid()) or model)
        places.append(language.fit(docs.withColumnRenamed("label", "lang"), settings).where)
    assert places[0] != os.getpid()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    found = quality_model.classify(docs, quality_model.fit(docs, labels)).collect()
    assert len(found) == 3 and all(0 <= r["score"] <= 1 for r in found)
    assert quality_model.classify(docs.limit(0), quality_model.fit(docs, labels.limit(0))).count() == 0


@pytest.mark.parametrize(("unit", "n"), [("ab c", 5_000_000), ("#<:\\", 500_000), ("    ", 5_000_000)])
def test_a_very_long_turn_is_parsed_in_a_few_bytes_a_character(unit, n):
    """The parser keeps no place to go back to: its memory beyond the turn itself is that of the parts it returns."""
    import tracemalloc

    said = unit * n
    escaped = said.translate({ord(c): "\\" + c for c in "\\#<:"})
    formatted = f"### user: {escaped} </turn>\n"
    del escaped
    tracemalloc.start()
    assert chat.parse(formatted) == [("user", said)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(said)
