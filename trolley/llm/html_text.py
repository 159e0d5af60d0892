"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut at block tags into flat blocks of text. Each block gets its word
count and link density, those of its neighbours, and what encloses it (article,
header, or boilerplate such as menus, adverts, forms and comments). A decision
tree, trained on the labelled sketches below, tells main text from the rest.

Character references are decoded, white space inside a block becomes one space,
and the kept blocks are joined by one line feed. ``<br>`` counts as white space.
Contents of scripts, styles, titles and the like are never text.

Edge cases: null, empty or textless html gives an empty text; unclosed tags,
comments and scripts reach to the end of the page; a "<" that begins no tag is
text. Each row is its own page, also when repeated, and columns other than the
page's are ignored.
"""

import html
import re

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

# The tags and the words in class and id that tell what a part of a page is.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button select option label fieldset".split())
MAIN = frozenset(("article", "main"))
UNWANTED = (
    "advert", "adsby", "sponsor", "promo", "banner", "cookie", "consent", "gdpr", "notice", "alert", "comment", "reply",
    "respond", "disqus", "sidebar", "footer", "nav", "menu", "breadcrumb", "toolbar", "share", "sharing", "social",
    "related", "newsletter", "subscri", "popup", "modal", "overlay", "login", "signup", "disclaimer", "widget",
    "masthead", "topbar", "pagination", "pager", "hidden",
)
UNWANTED_WORDS = frozenset("ad ads aside form search promoted legal copyright complementary contentinfo navigation".split())
WANTED_WORDS = frozenset("article main".split())
# Words that say where something stands or what holds it, not what it is about.
LAYOUT_WORDS = (
    "above action actions after area articles bar before below block body bottom box button buttons by card column "
    "container content dialog entries feed float footer form global group header icon icons inner item items js jp left "
    "link links list main mw number outer page panel policy post posts primary region right root row secondary section "
    "site slot stories text thread title to top under unit us view wp wrap wrapper zone"
).split()
# Parts of page layouts by name; an id with one of these is never about an article's matter.
LAYOUT_PARTS = ("adsby", "breadcrumb", "disqus", "footer", "masthead", "navbar", "pager", "pagination", "popup", "sidebar", "toolbar", "topbar")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg\b(?:[^>\"'/]|\"[^\"]*\"|'[^']*'|/(?!>))*+/>"
    r"|<(script|style|title|textarea|template|iframe|svg|noscript|noframes|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_ATTRIBUTES = frozenset("class id role style hidden aria-hidden".split())
# An unwanted word whole, with an ending, or run together with words of layout.
_UNWANTED = re.compile(
    rf"(?:{'|'.join(UNWANTED)})(?:s|es|r|er|ers|ing|isement|isements|ising|ised|ed|ional|be|bed|bers?|ption|ptions|ies|igation|ense"
    rf"|(?:{'|'.join((*LAYOUT_WORDS, *UNWANTED))})s?)*"
)
_LAYOUT = frozenset((*LAYOUT_WORDS, *WANTED_WORDS))
_WORD = re.compile(r"[a-z]+")

FEATURES = (
    "boilerplate", "in_header", "in_main", "page_has_main", "heading",
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
)


def _is_unwanted(name, value):
    """Whether a class, role or id names boilerplate.

    Classes and roles are names of layout, so any of their words counts. Ids are often
    made from headings, so all their words must be of layout.
    """
    for token in value.split():
        words = _WORD.findall(token)
        hits = [w in UNWANTED_WORDS or _UNWANTED.fullmatch(w) is not None for w in words]
        if any(hits) and (
            name != "id" or all(hit or w in _LAYOUT for w, hit in zip(words, hits))
            or any(hit and w.startswith(LAYOUT_PARTS) for w, hit in zip(words, hits))
        ):
            return True
    return False


def _hints(tag, attributes):
    """(unwanted, header, main) of a tag's own name, class, id and role."""
    unwanted, header, main = tag in BOILERPLATE, tag == "header", tag in MAIN
    if attributes and tag not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name not in _ATTRIBUTES:
                continue
            if name == "style":
                unwanted |= "display:none" in value.replace(" ", "")
            elif name in ("hidden", "aria-hidden"):
                unwanted |= value in ("", "true", "hidden")
            else:
                # A heading's id is its text.
                if not (name == "id" and tag in HEADINGS):
                    unwanted |= tag != "main" and _is_unwanted(name, value)
                for word in _WORD.findall(value):
                    header |= word in ("header", "banner") and tag not in MAIN
                    main |= name == "role" and word in WANTED_WORDS
    return unwanted, header, main


def blocks(page):
    """Flat blocks: (text, words, link density, unwanted, in header, in main, heading)."""
    found, stack, parts = [], [], []
    link_parts, in_link, at = [], 0, 0
    seen = {}

    def flush():
        nonlocal parts, link_parts
        if parts:
            text = "".join(parts)
            words = (html.unescape(text) if "&" in text else text).split()
            if words:
                linked = len(html.unescape("".join(link_parts)).split()) if link_parts else 0
                top = stack[-1] if stack else ("", False, False, False, False)
                found.append((" ".join(words), len(words), min(1.0, linked / len(words)), *top[1:]))
        parts, link_parts = [], []

    for match in _TAG.finditer(page):
        start = match.start()
        if start > at:
            text = page[at:start]
            parts.append(text)
            if in_link:
                link_parts.append(text)
        at = match.end()
        tag = match[3]
        if tag is None:
            continue
        tag, closing = tag.lower(), match[2]
        if tag not in BLOCKS and tag not in BOILERPLATE:
            if tag == "a":
                in_link = 0 if closing else 1
                if closing:
                    link_parts.append(" ")
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if tag == "li":  # an item ends the one before in the same list
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "li":
                    del stack[k:]
                if k < len(stack) and stack[k][0] in ("ul", "ol", "menu"):
                    break
        if tag == "hr" or match[4].endswith("/") and tag not in ("p", "div"):
            continue
        key = (tag, match[4])
        hints = seen.get(key)
        if hints is None:
            hints = seen[key] = _hints(*key)
        above = stack[-1] if stack else ("", False, False, False, False)
        stack.append((tag, above[1] or hints[0], above[2] or hints[1], above[3] or hints[2], tag in HEADINGS or above[4]))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return found


def block_features(found):
    """Feature rows of a page's blocks."""
    has_main = any(b[5] for b in found)
    edge = ("", 0, 0.0)
    rows = []
    for i, (_, words, density, unwanted, header, main, heading) in enumerate(found):
        before = found[i - 1] if i else edge
        after = found[i + 1] if i + 1 < len(found) else edge
        rows.append((
            float(unwanted), float(header), float(main), float(has_main), float(heading),
            float(words), density, float(before[1]), before[2], float(after[1]), after[2],
        ))
    return rows


# The labelled table: sketches of pages, block by block as
# (unwanted, in header, in main, heading, words, link density, is main text).
_MENU = [(1, 0, 0, 0, 1, 1.0, 0), (1, 0, 0, 0, 2, 1.0, 0), (1, 0, 0, 0, 1, 1.0, 0)]
_PLAIN_MENU = [(0, 0, 0, 0, 1, 1.0, 0), (0, 0, 0, 0, 2, 1.0, 0), (0, 0, 0, 0, 3, 1.0, 0)]
_SKETCHES = [
    [*_MENU, (1, 0, 0, 0, 30, 0.0, 0), (0, 0, 1, 1, 6, 0.0, 1), (0, 0, 1, 0, 60, 0.0, 1), (0, 0, 1, 0, 2, 0.0, 1),
     (0, 0, 1, 0, 1, 0.0, 1), (1, 0, 0, 0, 8, 0.2, 0)],
    [(0, 1, 0, 1, 3, 0.0, 0), (0, 1, 0, 0, 8, 0.0, 0), *_MENU, (0, 0, 1, 1, 4, 0.0, 1), (0, 0, 1, 0, 120, 0.1, 1),
     (0, 0, 1, 0, 12, 0.3, 1), (1, 0, 1, 0, 25, 0.1, 0), (0, 0, 1, 0, 80, 0.0, 1), (1, 0, 1, 1, 2, 0.0, 0),
     (1, 0, 1, 0, 40, 0.0, 0), (1, 0, 0, 0, 6, 0.5, 0)],
    [(0, 0, 0, 0, 14, 0.0, 0), *_PLAIN_MENU, (0, 1, 1, 1, 7, 0.0, 1), (0, 1, 1, 0, 5, 0.2, 1), (0, 0, 1, 0, 45, 0.0, 1),
     (0, 0, 1, 0, 3, 0.0, 1), (0, 0, 0, 0, 22, 0.0, 0), (0, 0, 0, 0, 60, 0.0, 0), (0, 0, 0, 1, 2, 0.0, 0)],
    [*_PLAIN_MENU, (0, 0, 0, 1, 6, 0.0, 1), (0, 0, 0, 0, 70, 0.0, 1), (0, 0, 0, 0, 5, 0.0, 1), (0, 0, 0, 0, 40, 0.1, 1),
     (0, 0, 0, 0, 25, 0.0, 1), *_PLAIN_MENU, (0, 0, 0, 0, 6, 0.6, 0)],
    [(0, 1, 0, 0, 4, 0.5, 0), *_PLAIN_MENU, (0, 0, 0, 1, 5, 0.0, 1), (0, 0, 0, 0, 35, 0.05, 1), (0, 0, 0, 1, 3, 0.0, 1),
     (0, 0, 0, 0, 90, 0.0, 1), (0, 0, 0, 0, 30, 0.9, 0), (0, 0, 0, 0, 4, 0.8, 0), (1, 0, 0, 0, 50, 0.0, 0)],
    [(1, 0, 0, 0, 3, 0.0, 0), (0, 0, 1, 1, 1, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 1), (0, 0, 1, 0, 4, 1.0, 1),
     (0, 0, 1, 0, 200, 0.02, 1), (1, 0, 1, 0, 4, 1.0, 0), (1, 0, 1, 0, 5, 1.0, 0), (1, 0, 1, 0, 60, 0.0, 0)],
    [(0, 0, 0, 0, 2, 0.0, 0), (0, 0, 0, 0, 3, 0.0, 0), *_PLAIN_MENU, (0, 0, 0, 0, 4, 0.0, 0), *_PLAIN_MENU],
    [(1, 0, 0, 0, 200, 0.0, 0), (0, 0, 1, 0, 3, 0.5, 1), (0, 0, 1, 0, 9, 0.0, 1), (1, 0, 0, 0, 9, 0.0, 0),
     (1, 0, 0, 1, 2, 0.0, 0), (1, 0, 0, 0, 150, 0.3, 0)],
    [(0, 0, 0, 0, 18, 0.0, 1), (0, 0, 0, 0, 55, 0.0, 1), (0, 0, 0, 0, 1, 0.0, 1), (0, 0, 0, 0, 33, 0.1, 1)],
    [(0, 1, 0, 1, 4, 0.0, 0), (0, 1, 0, 0, 25, 0.0, 0), (0, 0, 0, 0, 28, 0.0, 1), (0, 0, 0, 0, 44, 0.2, 1),
     (1, 0, 0, 0, 30, 0.0, 0)],
    [(0, 0, 0, 0, 40, 0.0, 0), (0, 0, 0, 1, 4, 0.0, 0), (0, 0, 1, 0, 30, 0.0, 1), (0, 0, 1, 0, 2, 0.0, 1),
     (0, 0, 0, 0, 35, 0.1, 0), (0, 0, 0, 0, 3, 0.0, 0)],
]


def labelled_blocks():
    """The labelled table as (features, label) rows."""
    rows = []
    for sketch in _SKETCHES:
        found = [("", words, density, unwanted, header, main, heading)
                 for unwanted, header, main, heading, words, density, _ in sketch]
        rows += zip(block_features(found), [float(block[-1]) for block in sketch])
    return rows


def train_tree(spark, depth=8):
    """A decision tree fitted on the labelled table, as nested (feature, threshold, left, right)."""
    data = spark.createDataFrame([(Vectors.dense(x), y) for x, y in labelled_blocks()], ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=256, seed=1).fit(data.repartition(1))

    def plain(node):
        if node.subtreeDepth() == 0:
            return node.prediction() > 0.5
        split = node.split()
        return split.featureIndex(), split.threshold(), plain(node.leftChild()), plain(node.rightChild())

    return plain(model._call_java("rootNode"))


def _is_main(tree, row):
    while not isinstance(tree, bool):
        feature, threshold, left, right = tree
        tree = left if row[feature] <= threshold else right
    return tree


def main_text(page, tree):
    """The main text of one page."""
    found = blocks(page or "")
    return "\n".join(b[0] for b, row in zip(found, block_features(found)) if _is_main(tree, row))


def extract(pages, tree=None):
    """page_id, url, text and n_chars of every page."""
    tree = tree or train_tree(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = []
            for start in range(0, batch.num_rows, 64):
                texts += [main_text(page, tree) for page in batch.column(2).slice(start, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
