"""Operators that map each text on its own: tokens, quality, pages."""

import random
from collections import Counter

import public_tokenizers
import pytest
from conftest import odd_rows
from tokenizers import Tokenizer

from netsieve.llm import blocks, quality, tokens


def library_counts(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_tokens_equal_the_library(odd):
    got = tokens.token_counts(odd, public_tokenizers.path("byte_bpe_50k.json")).collect()
    texts = [t for _, t, _ in odd_rows()]
    want = Counter(zip([i for i, *_ in odd_rows()], [len((t or "").encode()) for t in texts], library_counts(texts), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_tokens_of_strange_texts():
    rng = random.Random(1)
    texts = ["<|endoftext|>", " <|endoftext|>a<|endoftext|>", "don't we'll I'M", "\r\n\t x\r\n", "日本語、です。", "½ Ⅷ ١٢٣", "a\x00b", "x" * 3000]
    texts += ["".join(rng.choice(" \n\tabcd'st'll.,!éß😀1２½\x1c\x85中") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    count = tokens.counter(public_tokenizers.path("byte_bpe_50k.json")).count
    assert [count(t) for t in texts] == library_counts(texts)


def brute_quality(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered), failed,
    )


def test_quality_measures(odd, documents):
    for frame in (odd, documents):
        texts = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = quality.quality(frame).collect()
        fields = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert Counter(tuple(r[f] for f in fields) for r in got) == Counter((i, *brute_quality(t)) for i, t in texts)
        assert not any(r.kept and r.base_failed for r in got)


PLAIN = "Most of the river runs through a narrow valley with old farms on both of its banks.\nThe road beside it was built two centuries ago."


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (PLAIN, True),
        (PLAIN + "\nHome | News | Sport | Contact", True),
        ("Home | News | Sport | Contact | Login | Cart | Help | Terms | Map | About | More | End\n" * 1 + "Short line here.", False),
        ("BUY!! NOW!! BEST!! PRICES!! ONLY!! TODAY!! CALL!! US!! FREE!! GIFTS!! WOW!! YES!!", False),
        ("The$$$ river%%% runs### through&&& a*** narrow$$$ valley%%% with### old&&& farms*** on$$$ banks%%%", False),
        ("Over over over over hill hill hill hill river river river river stone stone stone stone.", False),
        ("one two three", False),
        (None, False),
    ],
)
def test_quality_verdicts(text, kept):
    assert quality.judge(text)[6] is kept


def test_quality_agrees_with_labels(spark, documents, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.kept, r.n_words) for r in quality.quality(documents).collect() if r.doc_id in labels and r.n_words >= 10]
    assert sum(k == bool(q) for q, k, _ in rows) >= 0.95 * len(rows)


def test_passing_keeps_rows_whole(odd, empty):
    kept = quality.passing(odd)
    assert kept.columns == odd.columns
    wanted = Counter((i, t) for i, t, _ in odd_rows() if quality.judge(t)[6])
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == wanted
    assert quality.quality(empty, with_text=True).count() == 0 and quality.passing(empty).count() == 0


PAGES = [
    ("<nav><a href=/>Home</a></nav><article><h1>A title</h1><p>First <b>bold</b>&amp; last.<p>Second</article><footer>&copy; us, all of us here.</footer>", "A title First bold& last. Second"),
    ("<header><a href=x>Start</a></header><div class='post-content'><h2>News</h2><p>It rained all day in the hills.</p></div><div id=comments><p>I like this long post a lot, thanks.</p></div>", "News It rained all day in the hills."),
    ("<article><p>One.</p><aside>Other stories you may like to read.</aside><form>Name <input><button>Send</button></form><p>Two.</p></article>", "One. Two."),
    ("<article><p>Cut &eacute; off", "Cut é off"),
    ("<script>var a='<p>No text, not at all.</p>'</script><style>p{}</style><!-- <p>Nor this one here.</p> --><main><p>Yes, this is text.</p></main>", "Yes, this is text."),
    ("<article><p>a\n b&nbsp;c<br>d</p></article>", "a b c d"),
    ("", ""), (None, ""), ("<p>", ""), ("<!-- open", ""),
]


def test_pages(spark):
    rows = [(i, None if i == 2 else f"u{i}", p) for i, (p, _) in enumerate(PAGES)] + [(None, "u", PAGES[0][0])] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("html", "markup")
    got = Counter((r.page_id, r.text, r.n_chars) for r in blocks.extract_text(frame, markup="markup").collect())
    want = Counter((i, t, len(t)) for i, (_, t) in enumerate(PAGES))
    want[(None, PAGES[0][1], len(PAGES[0][1]))] += 2
    assert got == want
    assert blocks.extract_text(frame.limit(0), markup="markup").count() == 0


def test_pages_of_the_table(spark, small):
    import html
    import re

    def article(page):
        inner = re.sub(r"</?(p|h1|br)[^>]*>", " ", page.split("<article>")[1].split("</article>")[0])
        return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())

    pages = spark.read.parquet(f"{small}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in blocks.extract_text(pages).collect()} == want


BODY = "<h1>A title</h1><p>It rained all day in the hills, and the river rose.</p><p>By noon the bridge was closed to all.</p>"
TEXT = "A title It rained all day in the hills, and the river rose. By noon the bridge was closed to all."
FRAMES = "<nav><a href=/>Home</a></nav>{}<div class='post-comments'><p>I like this long post a lot, thanks to all.</p></div><footer>All rights are ours, as ever.</footer>"


@pytest.mark.parametrize(
    "page",
    [
        "<article class='post tag-news'>@</article>",
        "<div class='content has-sidebar'>@</div>",
        "<div class='layout no-sidebar'><div class=content>@</div></div>",
        "<div class='single comments-open'><article>@</article></div>",
        "<main id='search-article'>@</main>",
        "<article><div class='article-header'>@</div></article>",
        "<form method=post><article>@</article></form>",
        "<form id=aspnet><div><div class=content>@</div></div></form>",
    ],
)
def test_class_names_of_whole_pages_do_not_lose_the_article(page):
    assert blocks.main_text(FRAMES.format(page.replace("@", BODY))) == TEXT


def test_small_forms_and_called_frames_go():
    for part in ("<form><p>Write to us here, and we will answer soon.</p></form>", "<div class='comment-list'><p>So true, I saw it with my own eyes.</p></div>",
                 "<article class=comment><p>So true, I saw it with my own eyes.</p></article>", "<div class='cookie_notice'><p>We use cookies to make this site work well.</p></div>"):
        assert blocks.main_text(f"<article>{BODY}{part}</article>") == TEXT


def test_neighbours_decide():
    def used(node):
        return set() if node.feature < 0 else {blocks.FEATURES[node.feature]} | used(node.left) | used(node.right)

    assert used(blocks.trained()) & {"words_before", "link_density_before", "words_after", "link_density_after"}
    long = "<p>" + "rain fell on the hills and on the river " * 6 + "all day.</p>"
    caption, link = "<p>The old stone bridge here</p>", "<p><a href=x>More of our best stories today</a></p>"
    assert "old stone bridge" in blocks.main_text(long + caption + long)
    assert "old stone bridge" not in blocks.main_text(link + caption + link + long)


def test_deep_markup_takes_linear_time():
    import time

    for page in ("<div>" * 50_000 + "x" + "</div>" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<p><h1>" * 30_000):
        start = time.process_time()
        blocks.main_text(page)
        assert time.process_time() - start < 2


def test_tree_fits_its_table():
    rows, labels = blocks.labelled_table()
    assert (blocks.verdicts(blocks.trained(), rows) == labels).mean() > 0.95
