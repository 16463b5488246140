"""Prefix trie, main text of pages, Merkle manifest: brute force, SQL, crafted and awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from tessera.llm import html_text, list_rank, merkle, prefix_trie, ranks
from tests.conftest import rows_of

CLASHING = "`first` int, part int, at int, place int, total int, node int, digest string, block int, tree int, id int, kind string, n_chars2 int"
EXTRA = (1, 2, 3, 4, 5, 6, "d", 7, 8, 9, "k", 10)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def duck_of(name, frame, columns):
    c = duckdb.connect()
    c.execute(f"CREATE TABLE {name} ({', '.join(f'{n} {t}' for n, t in columns)})")
    rows = [tuple(r[n] for n, _ in columns) for r in frame.collect()]
    if rows:
        c.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns))})", rows)
    return c


# ---------------------------------------------------------------- ranks and lists


def test_ranks_and_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.choice([None, 1, 2, 3]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k int, i int").repartition(7)
    found = ranks.ranked(df, ["g"], ["k", "i"], "test").collect()
    order = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])
    seen: dict = {}
    for g, k, i in sorted(rows, key=order):
        seen.setdefault(g, []).append((k, i))
    assert sorted((r.i, r.place, r.total) for r in found) == sorted((i, p, len(m)) for m in seen.values() for p, (_, i) in enumerate(m))
    values = [rng.randrange(100) for _ in range(700)]
    sums = ranks.running_sums(spark.createDataFrame(list(enumerate(values)), "p long, v long"), "p", ["v"], block=5).collect()
    assert {r.p: r.v for r in sums} == {p: sum(values[: p + 1]) for p in range(700)}


@pytest.mark.parametrize("final", [1, 1000])
def test_list_places(spark, final):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 400)
    lists = [ids[:1], ids[1:300], ids[300:]] if final > 1 else [ids]
    rows = [(x, m[k + 1] if k + 1 < len(m) else -1, rng.randrange(9)) for m in lists for k, x in enumerate(m)]
    found = list_rank.list_places(spark.createDataFrame(rows, "id long, next long, block int"), "block", final).collect()
    assert sorted((r.id, r.place) for r in found) == sorted((x, k) for m in lists for k, x in enumerate(m))


# ---------------------------------------------------------------- prefix trie


def brute_trie(rows):
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append(((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}")), role, text))
    own = {c: [(r, t) for _, r, t in sorted(m)] for c, m in turns.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + mine[h:]
    members: dict = {}
    for c, mine in whole.items():
        for d in range(len(mine) + 1):
            members.setdefault(tuple(mine[:d]), []).append(c)
    found = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = lambda p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p]
        saved = sum((len(members[p]) - 1) * (len(html_free_words(p[-1][1])) if p else 0) for p in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        found.append((min(convs), len(path), parent, len(convs), len(kids(path)), sum(not kids(p) for p in below), saved, sha(ends)))
    return sorted(found, key=lambda r: r[:2])


def html_free_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(-25, 45), 400, 401, 10**12 + 7]:
        for t in range(rng.randrange(1, 6)):
            rows.append((c, rng.choice([t, t, t, 0, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "a", "", None, "x y z\n"])))
    rows += [(3, 1, "user", "same")] * 3 + [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(c, t, "user", f"shared {t}") for c in range(60, 120) for t in range(4)]
    rows += [(200, t, "user", "long " * (t % 3)) for t in range(300)] + [(205, t, "user", "long " * (t % 3)) for t in range(300)]
    rows.append((300, 0, "user", "w " * 50_000))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("final", [1, 1 << 17])
def test_prefix_trie_by_brute_force(spark, final):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], f"conv_id long, turn long, role string, text string, {CLASHING}").repartition(5)
    found = prefix_trie.prefix_trie(df, final).collect()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[c] for c in columns) for r in found), key=lambda r: r[:2]) == brute_trie(rows)


def test_prefix_trie_equals_sql_on_awkward_rows(spark):
    rows = [r for r in conversation_rows() if r[0] not in (200, 205)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    duck = duck_of("conversations", df, [("conv_id", "BIGINT"), ("turn", "BIGINT"), ("role", "VARCHAR"), ("text", "VARCHAR")])
    assert rows_of(prefix_trie.prefix_trie(df)) == rows_of(duck.sql(prefix_trie.ORACLE))


def test_prefix_trie_of_an_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ---------------------------------------------------------------- main text

BODY = "<h1>The   title</h1><p>First <a href='x'>link</a> para&nbsp;graph &amp; more words, enough of them.<p>Second<br>one <b>b</b>old &lt;i&gt; &eacute;&#33;<ul><li>item one<li>item two</ul><div class=ad>Buy now</div><p>A last paragraph of a few more words.</p>"
BEFORE = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t=\"</p><article>no</article>\";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
AFTER = "<section id=comments><h3>Comments</h3><div class=comment><p>Nice article, I love it so much that I write many long words here.</p></div></section><aside>Side bar</aside><form><label>Name</label><input name=a></form><footer>&copy; 2020</footer></body></html>"
TEXT = "The title\n\nFirst link para graph & more words, enough of them.\n\nSecond one bold <i> é!\n\nitem one\n\nitem two\n\nA last paragraph of a few more words."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"{BEFORE}<article>{BODY}</article>{AFTER}", TEXT),
        (f"{BEFORE}<article>{BODY}{AFTER.replace('</body>', '</article></body>')}", TEXT),
        (f"{BEFORE}<main>{BODY}</main>{AFTER}", TEXT),
        (f"{BEFORE}<div role=main>{BODY}{AFTER}", TEXT),
        (f"{BEFORE}<div class=content>{BODY}</div>{AFTER}", TEXT),
        (f"<form id=f>{BEFORE}<article>{BODY}</article>{AFTER}</form>", TEXT),
        (f"{BEFORE}<article><header class=post-header><h1>T</h1><p>By me</p></header><p>Words.</p><footer>tags</footer></article>{AFTER}", "T\n\nWords."),
        (f"<nav>never closed<article>{BODY}", TEXT),
        ("<article>a<article class=comment>b</article>c<div class=share-bar>d</div></article><p>e", "a\n\nc"),
        ("<body><p class=ad>buy this<p>real text<footer>f", "real text"),
        ("<div class='content has-sidebar'>words of a page</div>", "words of a page"),
        ("no markup & a < b", "no markup & a < b"),
        ("<p>one <!-- <p>not this --> two<p>x <!-- never closed <p>y", "one two\n\nx"),
        ('<p title="a > b">in</p>', "in"),
        ("<nav>only a menu</nav>", ""),
        ("<script>only()", ""),
        (" \n\t ", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_main_text_of_crafted_pages(page, text):
    assert html_text.main_text(page, {}) == text


def test_best_region_by_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        w = [rng.choice([-3.0, -1.0, 0.5, 2.0]) for _ in range(rng.randrange(12))]
        first, end = html_text.best_region(w)
        most = max([0.0, *(sum(w[a:b]) for a in range(len(w)) for b in range(a + 1, len(w) + 1))])
        assert sum(w[first:end]) == most


def test_weights_are_learned_and_decide(spark):
    marked = "<body><div>ad words here</div><article><section><p>one two three four five</p></section></article><div>more ad words</div>"
    weights = html_text.learned_weights(spark.createDataFrame([(marked,)] * 50 + [(None,), ("<p>unmarked",)], "html string"))
    assert all((w > 0) == (" w" in kind) and w != 0 for kind, w in weights.items())
    assert weights["plain w:par"] > weights["plain w:other"] and weights["plain t:section@other"] > weights["plain t:div@other"]
    page = "<div>a b c d e f g h</div><section><p>1 2 3 4 5 6 7 8 9</p></section>"
    assert html_text.main_text(page, dict(weights)) == "1 2 3 4 5 6 7 8 9"
    # Without the negative weights of tags every block would be text.
    assert html_text.main_text(page, {k: abs(w) for k, w in weights.items()}) == "a b c d e f g h\n\n1 2 3 4 5 6 7 8 9"


def test_very_long_pages_take_linear_time():
    for piece in ("<a <a ", '<a "<b ', "<script>", "<!--", "<p>x", "<div class=ad>", "<", "&", "<a '", "<form>", "<form><h1>", "<article>"):
        html_text.main_text(piece * 60_000, {})


def test_extraction_of_awkward_rows(spark):
    rows = [(1, "u", f"<article>{BODY}</article>"), (1, "u", f"<article>{BODY}</article>"), (None, None, None), (2, None, ""), (3, "", "<p>" + "wörd " * 200_000)]
    found = html_text.extract(spark.createDataFrame([(*r, *EXTRA) for r in rows], f"page_id long, url string, html string, {CLASHING}")).collect()
    texts = sorted((str(r.page_id), r.url or "", r.text, r.n_chars) for r in found)
    long = " ".join(["wörd"] * 200_000)
    assert texts == sorted([("1", "u", TEXT, len(TEXT))] * 2 + [("None", "", "", 0), ("2", "", "", 0), ("3", "", long, len(long))])
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---------------------------------------------------------------- Merkle manifest


def brute_root(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[k : k + fanout])) for k in range(0, len(below), fanout)])
    return levels


@pytest.mark.parametrize("fanout, block_levels", [(2, 1), (2, 2), (3, 1), (8, 4)])
def test_versions_share_all_but_the_path(spark, fanout, block_levels):
    sizes = {None: 1, "a": 2, "b": 37, "z": 9, "é": 16}
    rows = [(g, i if i else None, sha(f"{g}{i}"), sha(f"{g}{i}!") if i % 3 == 0 else None) for g, n in sizes.items() for i in range(n)]
    found = merkle.manifest(spark.createDataFrame(rows, "lang string, doc_id long, leaf string, changed_leaf string").repartition(6), fanout, block_levels).collect()
    assert len(found) == len(rows)

    def tree(changed=None):
        groups = {g: brute_root([c if leaf == changed else leaf for g2, _, leaf, c in rows if g2 == g], fanout) for g in sizes}
        return groups, brute_root([groups[g][-1][0] for g in sizes], fanout)

    groups, top = tree()
    nodes = {d for levels in (*groups.values(), top) for level in levels for d in level}
    group_of = {leaf: g for g, _, leaf, _ in rows}
    for r in found:
        levels = groups[group_of[r.leaf]]
        assert (r.subroot, r.root) == (levels[-1][0], top[-1][0])
        if r.changed_leaf is None:
            assert r.folded_root == r.root and r.copied == []
            continue
        changed, changed_top = tree(r.leaf)
        assert r.folded_root == changed_top[-1][0]
        new = {d for levels in (*changed.values(), changed_top) for level in levels for d in level} - nodes - {r.changed_leaf}
        assert set(r.copied) == new


def awkward_documents(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["s", None, "", "ß"]), rng.choice(["en", "en", "de", None, "é", ""]), rng.choice([None, 0, 5]), rng.choice([None, "", "ABC déÉ", "abc", "x" * 70_000])) for i in range(300)]
    rows += [(7, "s", "en", 1, "Twice")] * 40 + [(7, "s", "en", 1, "other")] + [(None, None, None, None, None)] * 2
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {CLASHING}").repartition(5)


def test_manifest_equals_sql_on_awkward_rows(spark):
    docs = awkward_documents(spark)
    duck = duck_of("documents", docs, [("doc_id", "BIGINT"), ("source", "VARCHAR"), ("lang", "VARCHAR"), ("n_chars", "BIGINT"), ("text", "VARCHAR")])
    assert rows_of(merkle.verified_manifest(docs)) == rows_of(duck.sql(merkle.ORACLE))


def test_manifest_by_hand(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = merkle.verified_manifest(spark.createDataFrame([(1, "s", None, 2, "Aé")], schema)).first()
    leaf = sha("1:11:s-1:23:Aé")
    assert (one.leaf, one.subroot, one.root, one.proof_sha256) == (leaf, leaf, leaf, sha(""))
    assert one.folded_root == (sha("1:11:s-1:23:aé") if zlib.crc32(b"1") % 3 == 0 else leaf)
    assert merkle.verified_manifest(spark.createDataFrame([], schema)).count() == 0
