"""Main text of web pages by removal of site templates.

Every element subtree of a page is hashed (tags and text, without attributes), Spark counts the hashes per
host over different pages, and subtrees that recur on many pages of their host are deleted.
What is left is judged by its markup: elements that say they are menus, adverts, forms, comments
and the like go, and the article, else the main part, else the body gives the text.

Two shares of a host's pages tell a template: `FURNITURE_SHARE` for containers outside an article and
`SHARE` for everything else. Sentences may well be shared by articles, so paragraphs, lists and tables in an
article are never deleted, nor is a subtree with the larger part of its page's text.
"""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.html_tree import Tree, joined
from millrace.session import materialize

# A template is on so many different pages of a host at least, and on such a share of them.
MIN_PAGES = 3
FURNITURE_SHARE = 0.1
SHARE = 0.5
# Up to so many templates are handed to all tasks; more are joined page by page.
HANDED_OUT = 100_000

CONTAINERS = frozenset(
    "aside div dialog details fieldset footer form header menu nav search section table ul ol dl".split()
)
ARTICLE_CONTAINERS = frozenset("aside div dialog details footer form menu nav search section".split())
COUNTED = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figure center address".split())

# Fixed words of markup that is not main text: tags, roles, and parts of class names and ids.
DROPPED_TAGS = frozenset(
    "aside audio button canvas dialog footer form head iframe menu nav noembed noframes noscript object script "
    "search select style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising alert banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies discussion disqus footer gdpr login menu menus modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
MAIN_NAMES = frozenset("article articlebody content entry main post story".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# A class that says what a page has or lacks is no such part itself.
_SPOKEN_OF = frozenset("no has with without hide show is".split())


def _names(attributes: dict[str, str]) -> set[str]:
    """Lower-case words of class and id."""
    found = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in _SPOKEN_OF:
            found.update(words)
    return found


class Page:
    """A parsed page with what its markup says about each element."""

    def __init__(self, markup: str):
        self.tree = tree = Tree(markup)
        count = len(tree.tags)
        named = [tree.named(i) if tree.attributes[i] else {} for i in range(count)]
        names = [_names(a) if a else set() for a in named]
        # Elements that hold the title, the main part or the longest article are no furniture,
        # whatever their class.
        longest = max((tree.sizes[i] for i in range(1, count) if tree.tags[i] == "article"), default=0)
        holds, around = [False] * count, [False] * count
        for i in range(count - 1, 0, -1):
            tag = tree.tags[i]
            holds[i] = around[i] or tag in ("main", "h1") or tag == "article" and tree.sizes[i] == longest
            if holds[i]:
                around[tree.parents[i]] = True
        self.in_article = [False] * count
        self.dropped = [False] * count
        self.holds = holds
        for i in range(1, count):
            tag, parent, attributes = tree.tags[i], tree.parents[i], named[i]
            inside = self.in_article[parent] or tag in ("article", "main")
            said = names[i] & DROPPED_NAMES or attributes.get("role", "").lower() in DROPPED_ROLES
            protected = tag in ("html", "body") or (around[i] if tag == "article" else holds[i])
            hidden = (
                "hidden" in attributes
                or attributes.get("aria-hidden", "").lower() == "true"
                or bool(_HIDDEN.search(attributes.get("style", "")))
            )
            own = tag in DROPPED_TAGS and not (tag == "form" and holds[i]) or bool(said) and not protected
            # A header in the article holds its title; one outside is the site's.
            own = own or hidden or tag == "header" and not inside
            self.dropped[i] = self.dropped[parent] or own
            self.in_article[i] = inside and not self.dropped[i]
        self.named, self.names = named, names

    def counted(self) -> Iterator[tuple[int, bool]]:
        """(element, whether `SHARE` applies) of the subtrees that may be a template."""
        tree = self.tree
        half = tree.sizes[0] / 2
        for i in range(1, len(tree.tags)):
            tag = tree.tags[i]
            if tag not in COUNTED or not tree.sizes[i] or self.holds[i] and not self.dropped[i]:
                continue
            if self.in_article[i]:
                if tag in ARTICLE_CONTAINERS and tree.sizes[i] <= half:
                    yield i, True
            elif self.dropped[i] or tree.sizes[i] <= half:
                yield i, tag not in CONTAINERS

    def text(self, furniture: frozenset, common: frozenset) -> str:
        """The main text without subtrees of these hashes: recurring containers, and anything on half the pages."""
        tree, gone = self.tree, list(self.dropped)
        for i, strict in self.counted() if furniture or common else ():
            gone[i] = gone[i] or tree.hashes[i] in (common if strict else furniture)
        for i in range(1, len(tree.tags)):
            gone[i] = gone[i] or gone[tree.parents[i]]
        for roots in self._roots(gone):
            kept = bytearray(len(tree.tags))
            for root in roots:
                for i in tree.below(root):
                    kept[i] = not gone[i]
            text = joined(tree.pieces, kept.__getitem__)
            if text:
                return text
        return ""

    def _roots(self, gone: list[bool]) -> Iterator[list[int]]:
        """Elements to take the text from, the best first: articles, main parts, the body."""
        tree = self.tree
        alive = [i for i in range(1, len(tree.tags)) if not gone[i]]
        articles = _outermost(tree, [i for i in alive if tree.tags[i] == "article"])
        titled = [i for i in articles if any(tree.tags[j] == "h1" and not gone[j] for j in tree.below(i))]
        yield titled or articles
        yield _outermost(
            tree,
            [
                i
                for i in alive
                if tree.tags[i] == "main"
                or self.named[i].get("role", "").lower() == "main"
                or self.named[i].get("itemprop", "").lower() == "articlebody"
            ],
        )
        by_name = [i for i in alive if tree.tags[i] in ("div", "section", "td") and self.names[i] & MAIN_NAMES]
        left = [0] * len(tree.tags)
        for _, node, text in tree.pieces:
            if not gone[node]:
                left[node] += len(text.split())
        for i in range(len(left) - 1, 0, -1):
            left[tree.parents[i]] += left[i]
        # A part named so is the main one only with most of what is left.
        yield _outermost(tree, [i for i in by_name if 2 * left[i] > left[0]])
        self._drop_link_lists(gone)
        yield [0]

    def _drop_link_lists(self, gone: list[bool]) -> None:
        """On a page that names no main part: containers with most of their text in several links go."""
        tree = self.tree
        linked, links = [0] * len(tree.tags), [0] * len(tree.tags)
        for i in range(len(tree.tags) - 1, 0, -1):
            if tree.tags[i] == "a":
                linked[i], links[i] = tree.sizes[i], 1
            parent = tree.parents[i]
            linked[parent] += linked[i]
            links[parent] += links[i]
        for i in range(1, len(tree.tags)):
            crowded = links[i] > 1 and 2 * linked[i] > tree.sizes[i] and tree.tags[i] in CONTAINERS
            gone[i] = gone[i] or gone[tree.parents[i]] or crowded and not self.holds[i]


def _outermost(tree: Tree, nodes: list[int]) -> list[int]:
    out: list[int] = []
    for i in nodes:
        if not out or i >= tree.ends[out[-1]]:
            out.append(i)
    return out


# --- over a table ------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _keyed(pages: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """Each row as a struct, its host, and a digest of host and markup that equal pages share."""
    markup = F.coalesce(F.col(html_column), F.lit(""))
    host = host_of(F.col(url_column))
    digest = F.unhex(F.md5(F.concat(host, F.lit("\u0000"), markup).cast("binary")))
    return pages.select(F.struct("*").alias("page"), host.alias("host"), markup.alias("markup"), digest.alias("digest"))


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, digest, markup in zip(batch["host"], batch["digest"], batch["markup"]):
            page = Page(markup)
            rows += [(host, digest, h, strict) for h, strict in {(page.tree.hashes[i], s) for i, s in page.counted()}]
        yield pd.DataFrame(rows, columns=["host", "digest", "subtree", "strict"])


def site_templates(keyed: DataFrame, stored: DataFrame) -> DataFrame:
    """(host, subtree, strict) of the subtrees on many different pages of their host.

    Equal pages count once. A page without a host belongs to no site.
    """
    pages = keyed.where("host <> ''").select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("all"))
    # One expression more than the join needs: a plain shuffle, so that a hot host can be split.
    pages = pages.groupBy(F.hash("host").alias("spread"), "host").agg(F.first("all").alias("all")).drop("spread")
    counts = stored.groupBy("host", "subtree", "strict").agg(F.count("*").alias("pages"))
    needed = F.when(F.col("strict"), F.lit(SHARE)).otherwise(F.lit(FURNITURE_SHARE)) * F.col("all")
    return (
        counts.where(F.col("pages") >= MIN_PAGES)
        .join(pages, "host")
        .where(F.col("pages") >= needed)
        .select("host", "subtree", "strict")
    )


def _text_column(furniture, common):
    """Main texts of a batch; the arguments give the template hashes of a row."""
    def extract(markup: pd.Series, *found: pd.Series) -> pd.Series:
        rows = zip(markup, *found)
        return pd.Series([Page(m).text(furniture(*f), common(*f)) for m, *f in rows], dtype=object)

    return extract


def extract_text(
    pages: DataFrame, url_column: str = "url", html_column: str = "html", handed_out: int = HANDED_OUT
) -> DataFrame:
    """All rows with their columns as they are in the struct `page`, and the page's main `text`.

    A null page has an empty text, as has one without any. Character references are decoded, white space
    in a block is one space, blocks are joined by a line feed. Repeated rows stay; other columns of any name
    pass through. An empty table gives an empty result.

    Up to `handed_out` templates go to every task; more are joined to the pages by a digest of host and
    markup, with the same result.
    """
    keyed = _keyed(pages, url_column, html_column)
    schema = "host string, digest binary, subtree long, strict boolean"
    parsed = keyed.where("host <> ''").select("host", "digest", "markup").mapInPandas(_subtrees, schema)
    stored = materialize(parsed.distinct(), "subtrees")
    templates = materialize(site_templates(keyed, stored), "templates")
    if len(few := templates.limit(handed_out + 1).collect()) <= handed_out:
        by_host: dict[str, tuple[set, set]] = {}
        for r in few:
            by_host.setdefault(r.host, (set(), set()))[r.strict].add(r.subtree)
        none = frozenset()
        text = F.pandas_udf(
            _text_column(lambda h: by_host.get(h, (none, none))[0], lambda h: by_host.get(h, (none, none))[1]), "string"
        )
        return keyed.select("page", text("markup", "host").alias("text"))
    return _joined_text(keyed, stored, templates)


def _joined_text(keyed: DataFrame, stored: DataFrame, templates: DataFrame) -> DataFrame:
    """The same with each page's own templates joined to it; their number is bounded by its elements."""
    known = stored.join(templates, ["host", "subtree", "strict"])
    # The hash spreads the aggregate on more than the join's key, which leaves a plain shuffle.
    per_page = known.groupBy(F.hash("digest").alias("spread"), "digest").agg(
        F.collect_set(F.when(~F.col("strict"), F.col("subtree"))).alias("furniture"),
        F.collect_set(F.when(F.col("strict"), F.col("subtree"))).alias("common"),
    )
    both = keyed.join(per_page.drop("spread"), "digest", "left")

    def hashes(found):
        return frozenset() if found is None else frozenset(int(x) for x in found)

    text = F.pandas_udf(_text_column(lambda f, c: hashes(f), lambda f, c: hashes(c)), "string")
    return both.select("page", text("markup", "furniture", "common").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract_text(pages)
    return found.select("page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))
