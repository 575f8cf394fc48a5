"""The parts that run inside tasks, against the libraries and brute force."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import bagminhash, decontaminate, html_extract, language, pieces, shingles, token_files, words
from orderloom.llm.eliasfano import EliasFano
from orderloom.llm.suffix import WordAutomaton, covered

PIECE_PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
TOKENIZER = tokenizers.Tokenizer.from_file(WORD_PATH)
PIECES = pieces.Pieces(pieces.read_model(PIECE_PATH))
WORDS = token_files.Words(token_files.read_spec(WORD_PATH))

TEXTS = st.text(
    st.one_of(st.sampled_from(" \t\n\r▁.,'!<s>é́ßñ日本🙂a\u00a0\u3000\ufb01bcdT0"), st.characters(exclude_categories=["Cs"]))
)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_pieces_equal_the_library(texts):
    lengths, ids = PIECES.encode(texts)
    expected = [LIBRARY.encode(t) for t in texts]
    assert lengths.tolist() == list(map(len, expected))
    assert ids.tolist() == [i for e in expected for i in e]
    assert PIECES.decode(lengths, ids) == [LIBRARY.decode(e) for e in expected]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.sampled_from(["a<|endoftext|>b", "don't, I'll 'S", "<|startoftext|>"])), max_size=5))
def test_words_equal_the_library(texts):
    lengths, ids = WORDS.encode(texts)
    expected = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == list(map(len, expected))
    assert ids.tolist() == [i for e in expected for i in e]


def test_decoding_of_ids_that_no_text_has():
    odd = [[0], [1, 2], [300, 131, 300], [259, 200]]
    lengths = np.array(list(map(len, odd)))
    flat = np.array([i for ids in odd for i in ids], np.int32)
    assert PIECES.decode(lengths, flat) == [LIBRARY.decode(ids) for ids in odd]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700).map(sorted))
def test_elias_fano(values):
    coded = EliasFano.of(np.array(values, np.uint64))
    assert coded.values().tolist() == values
    assert [coded.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        coded.select(len(values))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_words_in_bytes(texts):
    found = words.words_of(pa.array(texts, pa.string()))
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert np.diff(found.ends).tolist() == list(map(len, expected))
    kept = words.kept_texts(found, np.ones(len(found.starts), bool)).to_pylist()
    assert kept == [" ".join(e) for e in expected]
    flat = [w for e in expected for w in e]
    assert len(set(found.hashes.tolist())) == len(set(flat))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=4), st.lists(st.sampled_from("abcd"), max_size=15))
def test_matching_statistics(texts, query):
    automaton = WordAutomaton(texts)
    known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)} | {()}
    expected = [max(n for n in range(i + 2) if tuple(query[i + 1 - n : i + 1]) in known) for i in range(len(query))]
    assert automaton.matches(query).tolist() == expected
    hit = [any(expected[e] >= 2 and e - 1 <= i <= e for e in range(len(query))) for i in range(len(query))]
    assert covered(np.array(expected, np.int64), 2).tolist() == hit


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=30), st.text("abcd", max_size=20))
def test_phrases(sample, text):
    count, rest = 0, text
    while rest:
        n = next((n for n in range(len(rest), 0, -1) if rest[:n] in sample), 1)
        rest, count = rest[n:], count + 1
    assert language.SuffixAutomaton(sample).phrases(text) == count


def _bag(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = min(5, len(found))
    return Counter(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) if size else Counter()


def _similarity(left, right):
    a, b = _bag(left), _bag(right)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if a and b else 0.0


def test_similarities_and_signatures():
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 40, 300)]
    texts = ["", "a b", "a b", "a b c", "x " * 50, "x " * 60]
    for share in (0.0, 0.02, 0.1, 0.3):
        texts.append(" ".join(w if rng.random() > share else f"n{rng.integers(9)}" for w in base))
    left, right = zip(*[(a, b) for a in texts for b in texts], strict=True)
    measured = shingles.similarities(pa.array(left, pa.string()), pa.array(right, pa.string()))
    assert np.allclose(measured, [_similarity(a, b) for a, b in zip(left, right, strict=True)])
    filled = pa.array(texts[1:], pa.string())
    signature = bagminhash.signatures(*shingles.shingle_bags(filled), len(filled), 4000)
    for i, a in enumerate(texts[1:]):
        for j, b in enumerate(texts[1:]):
            assert abs((signature[i] == signature[j]).mean() - _similarity(a, b)) < 0.05


def test_index_finds_what_brute_force_finds():
    rng = np.random.default_rng(1)
    make = lambda n: " ".join(f"w{min(int(x), 400)}" for x in rng.zipf(1.3, n))
    items = [(i, make(int(rng.integers(1, 40))) + ("\nA b" if i % 3 == 0 else "")) for i in range(40)] + [(99, " ?! ")]
    texts = ["", "A b"]
    for i in range(60):
        body = make(int(rng.integers(0, 300))).split(" ")
        if i % 2:
            held = items[i % 40][1].split()
            if i % 4 == 1 and len(held) > 6:
                held[3] = "changed"
            at = int(rng.integers(0, len(body) + 1))
            body[at:at] = held
        texts.append(" ".join(body))
    for share in (0.8, 0.6):
        found = decontaminate.Index(items, share).search(texts)
        for text, hits in zip(texts, found, strict=True):
            tokens = re.findall(r"\w+", text.lower())
            expected = set()
            for key, item in items:
                own = re.findall(r"\w+", item.lower())
                n = min(5, len(own))
                if not n:
                    continue
                bag = Counter(tuple(own[i : i + n]) for i in range(len(own) - n + 1))
                have = Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
                if sum((bag & have).values()) / sum(bag.values()) >= share:
                    expected.add(key)
            assert {h["item_id"] for h in hits} == expected


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><header><h1>no</h1></header><nav><ul><li><a href="/">no</a></ul></nav>
<div class="cookie-notice">no</div><div class='ad'>no</div><main><article class="post"><h1>Title &amp; more</h1>
<p>One<b> bold</b>&nbsp;and
  <i>more</i>.<br>Next<p>Two &lt;x&gt; &#233;<div class="share-buttons">no</div>
<ul><li>item 1<li>item 2</ul><form><input value=1>no</form><!-- no --><aside>no</aside>
<section class="comments"><article>no</article></section></article></main><footer>no</footer></body></html>"""


def test_main_text_of_a_page():
    expected = "Title & more\n\nOne bold and more. Next\n\nTwo <x> é\n\nitem 1\n\nitem 2"
    assert html_extract.extract_page(PAGE, set(), None) == expected
    plain = "<body><div class=menu>no</div><div id=x>Yes <b>it is</b></div><p>Also"
    assert html_extract.extract_page(plain, set(), None) == "Yes it is\n\nAlso"
    assert html_extract.extract_page(plain, set(), "body>div") == "Yes it is"
    # Only whole names are boilerplate: a word of one says nothing.
    kept = '<article><h1>T</h1><section id="related-work"><p>Related work</p></section><p>A <span class="search-term">needle</span></p></article>'
    assert html_extract.extract_page(kept, set(), None) == "T\n\nRelated work\n\nA needle"
    assert html_extract.extract_page('<main><div class="cookie-recipes"><p>Bake</p></div></main>', set(), None) == "Bake"
    for name in ("cookie-notice", "site-footer", "share-buttons", "ad-1", "related_posts", "post-comments", "comment-list"):
        assert html_extract.extract_page(f'<main>a<div class="x {name}">b</div></main>', set(), None) == "a"
    deep = "<div>" * 5000 + "x" * 1_000_000 + "</div>" * 5000
    assert html_extract.extract_page(deep, set(), None) == "x" * 1_000_000
    # The template's main element comes before an article elsewhere on the page.
    teaser = "<body><div class=a><article>Teaser</article></div><div class=b><p>Own text</p></div></body>"
    assert html_extract.extract_page(teaser, set(), "body>div.b") == "Own text"
    assert html_extract.extract_page(teaser, set(), None) == "Teaser"
    for broken in ("", "<", "<p", "a < b", "<script>x", "<!-- x", "<nav>x</p>", "</div>"):
        assert "script" not in html_extract.extract_page(broken, set(), None)
