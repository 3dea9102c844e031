"""Sharding, extraction, embeddings, archives, tokenisation, chat: brute force, round trips and edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from procura.llm import byte_bpe, chat, embedding_dedup, html_text, queries, sharding, warc

DOC_SCHEMA = "doc_id long, text string"


# sharding


def sharded(spark, rows, limit):
    df = spark.createDataFrame(rows, DOC_SCHEMA + ", shard string")
    out = sharding.extendible_shards(df, "doc_id", F.octet_length("text"), limit)
    assert out.columns == ["doc_id", "text", "shard", "shard_depth", "shard_bytes", "shard_rows", "oversized"]
    return out.collect()


def test_sharding_equals_sql(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randint(0, 400)) for i in range(600)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    got = sharding.extendible_shards(df, "doc_id", F.octet_length("text"), 3000).select("doc_id", "shard", "shard_depth", "shard_bytes", "shard_rows").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute("SELECT doc_id, shard, shard_depth, shard_bytes, shard_rows FROM (" + queries.OP1_SQL.replace(str(queries.SHARD_BYTES), "3000") + ")").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(r["shard_bytes"] for r in got) <= 3000 and len({r["shard"] for r in got}) > 30


def test_sharding_hot_key_equal_rows_and_nulls(spark):
    rows = [(7, f"{i:>50}", "c") for i in range(100)] + [(None, "same" * 10, "c")] * 60 + [(1, None, None), (2, "", None), (3, "y" * 5000, None)]
    got = sharded(spark, rows, 400)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    for rs in by.values():
        size = sum(len((r["text"] or "").encode()) for r in rs)
        assert size == rs[0]["shard_bytes"] and len(rs) == rs[0]["shard_rows"]
        assert size <= 400 or (len([r for r in rs if r["text"]]) == 1 and rs[0]["oversized"])


def test_sharding_empty_table(spark):
    assert sharded(spark, [], 100) == []


def test_sharding_uses_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], DOC_SCHEMA)
    out = sharding.extendible_shards(df, "doc_id", F.octet_length("text"), 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav>
<div class="cookie-notice">We use cookies, sorry.</div><div class="ad">Buy now, cheap!</div><!-- <p>no</p> -->
<article><h1>The &amp; title</h1><p>First <b>bold</b>
  text, with &#233;nt&eacute;s.<br>Second line.<p>Unclosed <i>paragraph, here.
<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><aside>Side note.</aside></article>
<form><input name=q><label>Search, please.</label></form><section id="comments"><p>I disagree, really.</p></section>
<footer>&copy; 2024, all rights.</footer>"""


def test_article_without_furniture():
    assert html_text.main_text(PAGE) == "The & title\nFirst bold text, with \u00e9nt\u00e9s. Second line.\nUnclosed paragraph, here.\none\ntwo\na\nb"


def test_path_ratios_pick_the_content_without_telling_tags():
    links = "".join(f"<div><span><a href=/{i}>Item {i}</a></span></div>" for i in range(12))
    story = "".join(f"<p>Sentence number {i}, which goes on for a while, has commas, and ends here. {'More words follow. ' * i}</p>" for i in range(6))
    text = html_text.main_text(f"<html><body><div>{links}</div><div>{story}</div></body></html>")
    assert text.count("\n") == 5 and "Item" not in text and "Sentence number 5" in text


@pytest.mark.parametrize("page,want", [(None, ""), ("", ""), ("plain  text", "plain text"), ("<p></p>", ""), ("a < b & c", "a < b & c"), ("<div><p>x</b></p></div></div>", "x"), ("<article>" + "<div>" * 3000 + "deep", "deep"), ("<p 'broken>text", "text")])
def test_odd_pages(page, want):
    assert html_text.main_text(page) == want


TEXT = "A paragraph of the story, with commas and a full stop. "


@pytest.mark.parametrize("page,want", [
    ('<article class="post comments-open"><p>Some text, here.</p></article>', "Some text, here."),
    ('<main id="main-no-sidebar"><h1>T</h1><p>Some text, here.</p></main>', "T\nSome text, here."),
    (f'<div class="content has-sidebar"><h2 id="related-work">Related work</h2><p>{TEXT * 3}</p></div>', f"Related work\n{(TEXT * 3).strip()}"),
    ("<body><h1>A lone headline</h1>" + f"<p>{TEXT * 6}</p>" * 10, "\n".join(["A lone headline", *[(TEXT * 6).strip()] * 10])),
    (f"<form><div><p>{TEXT * 9}</p></div><button>Go</button></form>", (TEXT * 9).strip()),
    (f"<article><p>{TEXT}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><section id='search-algorithms'><p>Search.</p></section><code class='comment'># hi</code></article>", f"{TEXT.strip()}\nLet x=1 be.\nSearch.\n# hi"),
    (f"<article><p>{TEXT * 4}</p><article class='comment'><p>{TEXT * 2}</p></article></article>", (TEXT * 4).strip()),
    (f"<div id='comments'><p>{TEXT * 8}</p></div><p>x</p>", (TEXT * 8).strip()),  # nearly all text is named so: no furniture
    (f"<div class='site-menu'>{TEXT * 2}</div><div><p>{TEXT * 4}</p><ul><li>a</li><li>b</li></ul><p>{TEXT * 4}</p></div><div class='cookie-notice'>{TEXT}</div>", f"{(TEXT * 4).strip()}\na\nb\n{(TEXT * 4).strip()}"),
])
def test_names_and_short_blocks_drop_no_content(page, want):
    assert html_text.main_text(page) == want


def test_path_scores_equal_ratios_by_definition():
    rnd = random.Random(6)
    page = "".join(f"<{rnd.choice(['p', 'div', 'ul><li', 'h2'])}>{'word, ' * rnd.randint(1, 9)}<b>end</b>. " for _ in range(60))
    blocks = html_text.blocks_of(page)
    by_path = {}
    for b in blocks:
        by_path.setdefault(b.path, []).append(b.text)

    def ratio(texts):
        sizes = [len(t) for t in texts]
        mean = sum(sizes) / len(sizes)
        return mean * (1 + (sum((x - mean) ** 2 for x in sizes) / len(sizes)) ** 0.5) * (1 + sum(t.count(",") + t.count(".") for t in texts) / len(texts))

    raw = [ratio(by_path[b.path]) for b in blocks]
    smooth = [(raw[max(i - 1, 0)] + 2 * raw[i] + raw[min(i + 1, len(raw) - 1)]) / 4 for i in range(len(raw))]
    assert len(by_path) > 5 and html_text.path_scores(blocks) == pytest.approx([(r * s) ** 0.5 for r, s in zip(raw, smooth, strict=True)])


def test_without_ratios_pages_without_telling_names_change(monkeypatch):
    links = "".join(f"<div><span>Item {i}</span></div>" for i in range(12))
    page = f"<html><body><div>{links}</div><div>{f'<p>{TEXT * 3}</p>' * 4}</div></body></html>"
    text = html_text.main_text(page)
    assert "Item" not in text and text.count("story") == 12
    monkeypatch.setattr(html_text, "path_scores", lambda blocks: [b.weight for b in blocks])
    assert html_text.main_text(page) != text


def test_deep_nesting_takes_linear_memory_and_time():
    tracemalloc.start()
    for page in ("<div>" * 50_000 + "deep</q>" + "</i>" * 50_000, "<ul>" * 50_000 + "<p>y" * 20_000, "<div><p>" * 50_000 + "z"):
        assert html_text.main_text(page)[:1] in "dyz"
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, None, "u", "t"), (1, "<article>caf&eacute;</article>", None, "t"), (None, "x" * 200000, "u", "t")], "page_id long, html string, url string, text string")
    got = html_text.extract(df, "html", ["page_id", "url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["n_chars"], r["text"][:4]) for r in got.collect()) == [(0, ""), (4, "caf\u00e9"), (200000, "xxxx")]
    assert html_text.extract(df.limit(0), "html", ["page_id"]).count() == 0


# embeddings


def test_embedding_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 24))
    near = base[rng.integers(0, 20, 140)] + 0.05 * rng.standard_normal((140, 24))
    vectors = np.concatenate([base, near, base[:5], base[:5] * 3]).astype(np.float32)
    rows = [(int(i), [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, None], [1.0, 0.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, "vec_id", "embedding", 0.95).collect()}
    x = vectors.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    component = list(range(len(x)))
    for _ in range(len(x)):
        component = [min(component[j] for j in np.flatnonzero(close[i])) for i in range(len(x))]
    assert len(got) == len(rows)
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (close[i].sum() - 1, component[i], component[i] == i)
    assert all((got[1000 + i]["n_links"], got[1000 + i]["component_id"], got[1000 + i]["kept"]) == (0, 1000 + i, True) for i in range(len(odd)))


def test_embedding_windows_reach_over_small_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rng = np.random.default_rng(5)
    center = rng.standard_normal(16)
    rows = [(i, [float(v) for v in center + 0.02 * rng.standard_normal(16)]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        got = embedding_dedup.near_duplicates(df, "vec_id", "embedding", 0.95, passes=2).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r["component_id"] for r in got} == {0} and {r["n_links"] for r in got} == {79}


def test_embedding_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df, "vec_id", "embedding", 0.95).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, 0, True), (0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True)]
    assert embedding_dedup.near_duplicates(df.limit(0), "vec_id", "embedding", 0.95).count() == 0


def test_embedding_hot_third_keeps_its_links(spark):
    rng = np.random.default_rng(6)
    far = rng.standard_normal((600, 32))
    linked = rng.standard_normal(32) + 0.12 * rng.standard_normal((300, 32))
    cone = rng.standard_normal(32) + 0.4 * rng.standard_normal((300, 32))
    single = cone[:40] + 0.28 * rng.standard_normal((40, 32))
    x = np.concatenate([far, linked, cone, single])
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df, "vec_id", "embedding", 0.95, window=32).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    want = close.sum(axis=1) - 1
    for part in (slice(600, 900), slice(900, 1240)):
        assert 0.99 * want[part].sum() <= sum(got[i] for i in range(part.start, part.stop)) <= want[part].sum()
    assert want[600:900].sum() > 80_000 and want[900:].sum() > 20 and all(got[i] <= want[i] for i in got)


def test_embedding_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(7)
    for dense in (np.ones((90, 70), bool), np.kron(np.eye(3, dtype=bool), np.ones((30, 40), bool)), rng.random((60, 60)) < 0.2):
        a, b = embedding_dedup._spanning(dense)
        assert dense[a, b].all() and len(a) < sum(dense.shape)
        kept = np.zeros(dense.shape, bool)
        kept[a, b] = True
        for _ in range(12):  # reached in an even number of steps
            kept = (kept @ kept.T @ kept) | kept
        full = dense
        for _ in range(12):
            full = (full @ full.T @ full) | full
        assert (kept == full).all()


def test_more_vectors_take_more_passes():
    assert embedding_dedup.passes_for(10**9, 0.95) > embedding_dedup.passes_for(10**5, 0.95) >= 2


# archives


def test_warc_round_trip(spark):
    big = "".join(random.Random(2).choices("abc \u00e9\r\n0", k=90000))
    pages = [(3, "http://a/b c?\u00e9", "<p>one</p>"), (1, None, "<p>one</p>"), (2, "u", None), (5, "u", ""), (6, "v", big), (4, "w", big), (7, "x", big + "."), (8, "y", "WARC/1.1\r\n\r\n\r\n0\r\n\r\n"), (7, "x", big + "."), (None, "n", "<p>one</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.read_archives(spark, warc.write_archives(df, "page_id", "url", F.encode("html", "UTF-8"))).collect()
    least = {}
    for p, _, h in pages:
        if p is not None:
            least[h or ""] = min(least.get(h or "", p), p)
    want = []
    for p, u, h in pages:
        raw, first = (h or "").encode(), least[h or ""]
        again = p != first
        want.append((None if p is None else str(p), u, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", str(first) if again else None, None if again else raw))
    mine = [(r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)


def test_warc_revisits_only_from_a_length_on(spark):
    df = spark.createDataFrame([(i, "u", "x" * n) for i, n in enumerate([3, 3, 9, 9])], "page_id long, url string, html string")
    got = warc.read_archives(spark, warc.write_archives(df, "page_id", "url", F.encode("html", "UTF-8"), revisit_from=5))
    assert sorted((r["page_id"], r["record_type"]) for r in got.collect()) == [("0", "response"), ("1", "response"), ("2", "response"), ("3", "revisit")]
    path = warc.write_archives(df.limit(0), "page_id", "url", F.encode("html", "UTF-8"))
    assert warc.read_archives(spark, path).count() == 0


def test_chunked_framing_and_damage():
    for data in (b"", b"a", bytes(range(256)) * 100):
        assert warc.dechunked(warc.chunked(data, 1000)) == data
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"4\r\nabc\r\n0\r\n\r\n")
    records = warc.capture_records(1, "u", b"z" * 100, "D", None, 64)
    parsed = list(warc.parse_archive(b"".join(records)))
    assert [f.get("warc-segment-number") for f, _ in parsed] == [str(i + 1) for i in range(len(records))]
    assert parsed[-1][0]["warc-segment-total-length"] == str(sum(len(b) for _, b in parsed))
    with pytest.raises(ValueError):
        list(warc.parse_archive(records[0][:-10]))


def test_missing_segment_is_an_error(spark, tmp_path):
    records = warc.capture_records(1, "u", b"z" * 500, "D", None, 128)
    (tmp_path / "part-0").write_bytes(b"".join(records[:1] + records[2:]))
    with pytest.raises(Exception, match="segments missing"):
        warc.read_archives(spark, str(tmp_path)).collect()


# tokenisation


def encoders():
    import public_tokenizers as P
    import tiktoken

    path = P.path(queries.RANKS)
    tokens = byte_bpe.read_ranks(path)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    return byte_bpe.worker_bpe(path, P.PATTERN), theirs, path, P.PATTERN


def test_byte_bpe_equals_tiktoken():
    mine, theirs, *_ = encoders()
    rnd = random.Random(6)
    marks = [" ", "  ", "\n", "\r\n", "\t", "'s", "'LL", "\u00a0", "\u2003", "\u3000", "\x1c", "\x85", "\x00", "\u2581", "\u200b", "\ufeff", "\U0001f600", "\u0301", "\u0660", "\u4e2d", " \n", "<unk>", "<|endoftext|>"]
    letters = [chr(i) for i in range(33, 400)]
    texts = ["".join(rnd.choices(letters + marks * 12, k=rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["", "a" * 3000, " " * 999, "word " * 500, "\u00e9" * 700]
    for text, packed in zip(texts, mine.encode_all(texts), strict=True):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == theirs.encode_ordinary(text)
        assert mine.decode(packed) == text.encode()


def test_byte_bpe_rows(spark):
    _, theirs, path, pattern = encoders()
    df = spark.createDataFrame([(1, "Hello w\u00f6rld", 5), (None, None, 6), (2, "", 7), (2, "Hello w\u00f6rld", 8)], "doc_id long, text string, n_tokens int")
    got = byte_bpe.encode_decode(df, "text", path, pattern, ["doc_id"]).collect()
    ids = theirs.encode_ordinary("Hello w\u00f6rld")
    want = [(1, len(ids), "Hello w\u00f6rld"), (2, 0, ""), (2, len(ids), "Hello w\u00f6rld"), (None, 0, "")]
    assert sorted(((r["doc_id"], r["n_tokens"], bytes(r["decoded"]).decode()) for r in got), key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode_decode(df.limit(0), "text", path, pattern, ["doc_id"], digests=True).count() == 0


# chat


def test_escaping_is_reversible():
    rnd = random.Random(7)
    pieces = ["\\", "#", "##", "### ", "### assistant: ", "</turn>\n", "</turn>", "<image:0>", "<", ">", ":", "a", " ", "\n", "\u00e9"]
    for _ in range(3000):
        role, text = ("".join(rnd.choices(pieces, k=rnd.randint(0, n))) for n in (4, 12))
        formatted, a, b, _ = chat.format_turn(role, [{"kind": "text", "text": text, "ref": None, "size": None}])
        assert chat.read_turn(formatted) == (role, text)
        content = formatted[formatted.index(": ") :]
        assert "</turn>" not in chat.escape(text).replace("\\</turn>", "") and "###" not in chat.escape(text).replace("\\#", "")
        assert (b - a > 0) == (role == "assistant" and bool(text)) and content.endswith("</turn>\n")


def test_turns_are_found_by_control_strings_whatever_the_pieces():
    rnd = random.Random(9)
    pieces = ["\\", "#", "###", "### user: ", "</turn>\n", "</turn>", "<audio:", ": ", "a", "\n", "\u00e9"]
    for _ in range(400):
        turns = [tuple("".join(rnd.choices(pieces, k=rnd.randint(0, 9))) for _ in range(2)) for _ in range(rnd.randint(0, 5))]
        text = "".join(chat.format_turn(role, [{"kind": "text", "text": t, "ref": None, "size": None}])[0] for role, t in turns)
        assert chat.read_turns(text) == turns
        reader, got = chat.TurnReader(), []
        while text:
            cut = rnd.randint(1, 12)
            got += reader.feed(text[:cut])
            text = text[cut:]
        reader.finish()
        assert got == turns
    for bad in ("### user: a", "user: a</turn>\n", "### user</turn>\n", "### user: a</turn>\nx", "### user: a### user: b</turn>\n"):
        with pytest.raises(ValueError):
            chat.read_turns(bad)


def test_a_missing_escape_shows_when_read_back(monkeypatch):
    text = "x</turn>\n### assistant: y"
    part = [{"kind": "text", "text": text, "ref": None, "size": None}]
    assert chat.read_turns(chat.format_turn("user", part)[0]) == [("user", text)]
    monkeypatch.setattr(chat, "escape", lambda t: t)
    assert chat.read_turns(chat.format_turn("user", part)[0]) == [("user", "x"), ("assistant", "y")]


def test_a_very_long_turn_takes_a_few_bytes_a_character():
    text = ("plain words and \\\\ ### </turn>\n " * 700_000)[:20_000_000]
    tracemalloc.start()
    formatted, a, b, _ = chat.format_turn("assistant", [{"kind": "text", "text": text, "ref": None, "size": None}])
    assert chat.read_turn(formatted) == ("assistant", text) and chat.unescape(formatted[a:b]) == text
    assert tracemalloc.get_traced_memory()[1] < 25 * len(text)
    tracemalloc.stop()


def test_typed_parts_become_placeholders():
    parts = [{"kind": "text", "text": "see <image:0> ", "ref": None, "size": None}, {"kind": "image", "text": None, "ref": "s3://i", "size": 28 * 28 * 10}, {"kind": "audio", "text": None, "ref": None, "size": 1001}, {"kind": "document", "text": None, "ref": "d", "size": None}]
    formatted, a, b, attachments = chat.format_turn("assistant", parts)
    assert formatted[a:b] == "see \\<image:0> <image:0><audio:1><document:2>"
    assert [(x["kind"], x["ref"], x["ordinal"], x["tokens"]) for x in attachments] == [("image", "s3://i", 0, 10), ("audio", "", 1, 26), ("document", "d", 2, 1)]
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video", "text": None, "ref": None, "size": None}])


def test_conversations_read_back(spark):
    rows = [(1, 1, "assistant", "b # \\"), (1, 0, "user", "a"), (1, 2, "assistant", "</turn>\n### user: x"), (None, 0, None, None), (2, 5, "assistant", None), (2, 5, "assistant", "same"), (2, 5, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    turns = chat.format_turns(df, "conv_id", "turn", "role", chat.text_part(F.col("text")))
    got = {r["conv_id"]: r for r in chat.read_conversations(turns, "conv_id", "turn").collect()}
    one = [("user", "a"), ("assistant", "b # \\"), ("assistant", "</turn>\n### user: x")]
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in one).encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256((one[1][1] + one[2][1]).encode()).hexdigest()
    assert got[1]["loss_chars"] == len(one[1][1] + one[2][1]) and got[2]["n_turns"] == 3 and got[2]["loss_chars"] == 8
    assert got[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest() and got[None]["loss_chars"] == 0
    assert got[1]["formatted_chars"] == turns.where("conv_id = 1").agg(F.sum(F.length("formatted"))).first()[0]
    assert chat.read_conversations(turns.limit(0), "conv_id", "turn").count() == 0
