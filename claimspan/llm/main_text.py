"""Main text of web pages with a site style tree.

The pages of a host are merged: elements with the same path of tags, classes
and ids are one node of the host's tree. Pages of a host with the same text
are one page there, so an article in many copies does not look like a menu.
For each node it is counted in how many pages it stands, which sequences of
children it has there (its presentation), and in how many pages each of its
texts stands (its content).

* Presentation importance: the entropy of its child sequences over its pages.
* Content importance: the entropy of the texts below it, weighted by length,
  each rated by the pages of the node it stands in. A text of its own for each
  page makes 1; the same text on all pages makes 0.

Both, weighted ``1 - CONTENT`` to ``CONTENT``, make the importance of a node.
From each page the branches under ``LEAST`` are removed. Nodes of fewer than
``MIN_PAGES`` pages say too little: they stay, as do the page's own roots and
main parts. What a page itself marks as no text of its own (menus, footers,
forms, adverts, comments ... by tag, role, class or id) is removed in any case;
inside ``article`` and ``main`` a name that could also be one of the article's
own parts (discussion, related, notice ...) needs further evidence: low
importance, mostly links, or neither a sentence nor a heading below it. And
lists of links outside the main part are too. Nothing goes for standing outside
of ``article`` or ``main`` alone.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from claimspan.llm.common import Scratch, aliased, arrow, batch_of, chunks, extended, map_arrow, restored
from claimspan.llm.html_tree import Element, digest, read

CONTENT = 0.9
LEAST = 0.5
#: Of two pages that share a text nothing tells whether it is their menu or their article.
MIN_PAGES = 3
#: Link text of a list, table or division that is a menu.
LINK_SHARE = 0.8
#: Link text of an element inside the main part that is named like noise.
NAMED_LINK_SHARE = 0.5
#: Distinct counts a task holds before it passes them on.
HELD = 100_000

_PAGE, _STYLE, _TEXT = 0, 1, 2
_LISTS = {"ul", "ol", "dl", "table", "div", "section", "td"}


def host(url: str) -> Column:
    """The host of a URL in lower case; "" if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _contents(pages: DataFrame) -> DataFrame:
    """(host, content, features): what the tree counts of each page, once per host and text.

    ``content`` is a digest of the text that the page does not mark as noise.
    Of pages with one text and different elements the least ``features`` stand.
    """
    ddl = "host string, content long, features binary"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: set[tuple] = set()
        for batch in chunks(batches, "html"):
            rows = []
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                elements, blocks = read(html)
                features = {(e.path, _PAGE, 0, 0) for e in elements}
                features |= {(e.path, _STYLE, digest(" ".join(e.kids)), 0) for e in elements if not e.parent or e.path != e.parent.path}
                features |= {(e.path, _TEXT, digest(t), len(t)) for e, t in blocks}
                content = digest("\n\n".join(t for e, t in blocks if not e.noise))
                held: dict[str, list[tuple]] = {}
                for path, *feature in sorted(features):
                    held.setdefault(path, []).append(tuple(feature))
                packed = zlib.compress(pickle.dumps(list(held.items()), 4), 1)
                key = (name, content, xxh3_64_intdigest(packed))
                if key not in passed:
                    passed.add(key)
                    rows.append((name, content, packed))
            if len(passed) > HELD:
                passed.clear()
            yield batch_of(schema, *[[r[i] for r in rows] for i in range(3)])

    parsed = map_arrow(pages.select("host", F.coalesce("html", F.lit("")).alias("html")), run, ddl)
    return parsed.groupBy("host", "content").agg(F.min("features").alias("features"))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of each node of each host's tree; ``pages`` has host and html."""
    ddl = "host string, path string, kind int, feature long, n long, size long"
    schema = arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple] = Counter()

        def out() -> pa.RecordBatch:
            keys = list(zip(*held, strict=True)) or [()] * 5
            return batch_of(schema, *[list(k) for k in keys[:4]], list(held.values()), list(keys[4]))

        for batch in chunks(batches, "features"):
            for name, packed in zip(batch.column("host").to_pylist(), batch.column("features").to_pylist(), strict=True):
                held.update((name, path, *f) for path, found in pickle.loads(zlib.decompress(packed)) for f in found)
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    seen = map_arrow(_contents(pages), run, ddl)
    features = seen.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
    of = lambda kind, e: F.coalesce(F.sum(F.when(F.col("kind") == kind, e)), F.lit(0.0))
    n, ln = F.col("n").cast("double"), F.log(F.col("n"))
    nodes = features.groupBy("host", "path").agg(
        of(_PAGE, n).alias("pages"),
        of(_STYLE, n).alias("styled"),
        of(_STYLE, n * ln).alias("style_log"),
        of(_TEXT, F.col("size") * n).alias("size"),
        of(_TEXT, F.col("size") * n * ln).alias("size_log"),
    )
    # the content of a node is that of all nodes below it, too
    names = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, 1, i), "/"))
    # texts are rated by the pages of the node they stand in
    rated = F.when(F.col("pages") > 1, F.col("size_log") / F.log("pages")).otherwise(F.lit(0.0))
    below = nodes.select("host", F.explode(above).alias("path"), "size", rated.alias("known"))
    content = below.groupBy("host", "path").agg(F.sum("size").alias("all_size"), F.sum("known").alias("all_known"))
    style = (F.log("styled") - F.col("style_log") / F.col("styled")) / F.log("pages")
    importance = F.when(
        F.col("pages") > 1,
        (1 - CONTENT) * style + CONTENT * F.when(F.col("all_size") > 0, 1 - F.col("all_known") / F.col("all_size")).otherwise(F.lit(0.0)),
    ).otherwise(F.lit(1.0))
    return nodes.join(content, ["host", "path"]).select("host", "path", F.col("pages").cast("long").alias("pages"), importance.alias("importance"))


def _text(html: str, low: set[str]) -> str:
    elements, blocks = read(html)
    gone: dict[int, bool] = {}
    for e in elements:  # parents stand before their children
        up = gone.get(id(e.parent), False)
        menu = (
            e.tag in _LISTS and not e.main and e.links >= 3 and e.chars > 0 and e.linked >= LINK_SHARE * e.chars
        )
        named = e.suspect and e.chars > 0 and (not e.running or e.path in low or e.linked >= NAMED_LINK_SHARE * e.chars)
        kept_root = e.tag in ("", "html", "body", "article", "main")
        gone[id(e)] = up or e.noise or menu or named or (not kept_root and not _prose(e) and e.path in low)
    return "\n\n".join(t for e, t in blocks if not gone[id(e)])


def _prose(e: Element) -> bool:
    """Whether an element is a part of running text, which goes or stays with its branch."""
    return e.main and e.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "tr", "dd", "dt")


def main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each page, its blocks joined by two line feeds.

    * A null or empty page has the empty text. Unclosed elements end with their
      parents; a page of plain text is its own main text.
    * Pages without a host (a null or odd URL) are merged as one host, "".
    * Repeated pages have equal texts, and count once in the tree. Pages are read
      whole. An empty table gives no rows. A column named ``text`` is replaced, even if it holds
      the pages; others are carried along, nulls too.
    """
    pages, names, _ = aliased(pages)
    url, html = names[url], names[html]
    scratch = Scratch(pages.sparkSession, "styletree")
    sites = pages.select(host(url).alias("host"), F.col(f"`{html}`").alias("html"))
    low = style_tree(sites).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LEAST))
    # stored, so that Spark knows its size and broadcasts it only if that is small
    low = scratch.table(low.groupBy("host").agg(F.collect_set("path").alias("_low")), "low", keep=True)
    joined = pages.withColumn("_host", host(url)).join(low.withColumnRenamed("host", "_host"), "_host", "left")

    def setup():
        seen: list = [None, set()]

        def run(batch: pa.RecordBatch) -> tuple[list[str]]:
            out = []
            lists = batch.column("_low")
            for i, page in enumerate(batch.column(html).to_pylist()):
                paths = lists[i].as_py() or []
                if paths != seen[0]:
                    seen[:] = [paths, set(paths)]
                out.append(_text(page or "", seen[1]))
            return (out,)

        return run

    return restored(extended(joined, "text string", html, setup), names, ["text"])
