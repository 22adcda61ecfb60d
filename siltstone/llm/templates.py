"""Benchmark decontamination by template canonicalisation, DataFrame operations only.

Texts are read in two ways. As templates, names, numbers and quantities (a number with its unit) turn into
typed placeholders, other words are lower-cased, punctuation goes. As words, each word is one token whatever
its case, and only numbers are placeholders: a text in capitals or title case says nothing about names.
Windows of tokens are hash-joined between documents and benchmark items. Where they meet, document and item
are laid side by side at that offset, and the longest run of equal tokens counts in which the slots are
consistent, each of the item's values replaced by one and the same value. So a question is found as it
stands, whatever its case, and with other names and numbers put in, but not by windows that agree by chance.

All windows of the items are kept and every second of a document, which finds every common run of
``WINDOW + STRIDE - 1`` tokens. A window with fewer than ``LITERALS`` literal words is joined by its values
instead of its placeholders: a run as it stands has the same values, and a run with new values, of which at
least half must be literal words, always holds a window at every second place that has two of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import written

WINDOW = 5
STRIDE = 2
#: Items of at least this many tokens are also looked for with new values; shorter ones only as they stand.
LEAST_TOKENS = 8
#: Literal words that a window needs to be joined by its placeholders.
LITERALS = 2
#: Length of the run that convicts a document; the whole item if it is shorter.
RUN = 13

# Units of measure that may follow a number.
UNITS = (
    "%", "km", "m", "cm", "mm", "kg", "g", "mg", "t", "l", "ml", "s", "ms", "min", "h", "w", "kw", "v", "a", "hz",
    "mph", "kmh", "ft", "inch", "inches", "miles", "mile", "metres", "meters", "metre", "meter", "feet", "pounds",
    "lb", "oz", "grams", "gram", "litres", "liters", "litre", "liter", "seconds", "second", "minutes", "minute",
    "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year", "dollars", "dollar",
    "cents", "cent", "euros", "euro", "usd", "eur", "gbp", "percent", "degrees", "degree",
)

_NAME = r"\p{Lu}[\p{L}\p{M}\p{N}'’-]*+(?: \p{Lu}[\p{L}\p{M}\p{N}'’-]*+)*+"
_NUMBER = rf"[$€£]?[0-9]++(?:[.,:/][0-9]++)*+(?: ?(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))?+"
_WORD = r"[\p{L}\p{M}\p{N}]++"
_TOKEN = f"{_NAME}|{_NUMBER}|{_WORD}"


def tokens_of(text: Column) -> Column:
    """A text's names, numbers, quantities and words as they stand; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), F.array().cast("array<string>"))


def template_of(token: Column) -> Column:
    """``<name>``, ``<number>``, ``<quantity>`` or the word in lower case."""
    first, last = F.substring(token, 1, 1), F.substring(token, -1, 1)
    number = first.isin("$", "€", "£") | first.between("0", "9")
    return (
        F.when(number, F.when(last.between("0", "9") & first.between("0", "9"), "<number>").otherwise("<quantity>"))
        .when(F.lower(first) != first, "<name>")
        .otherwise(F.lower(token))
    )


def words_of(text: Column) -> Column:
    """A text's words and numbers without regard to case; none for NULL."""
    folded = F.lower(F.upper(text))
    return F.coalesce(F.regexp_extract_all(folded, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def word_template_of(word: Column) -> Column:
    """``<number>`` for a word that begins with a digit, else the word."""
    return F.when(F.substring(word, 1, 1).between("0", "9"), "<number>").otherwise(word)


def _is_slot(template: Column) -> Column:
    return F.startswith(template, F.lit("<"))


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, folded (read as words), tokens and templates of the items."""
    texts = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null")

    def read(folded: bool, tokens: Column, template, least: int) -> DataFrame:
        cut = texts.select("item_id", F.lit(folded).alias("folded"), tokens.alias("item_tokens"))
        cut = cut.where(F.size("item_tokens") >= least).distinct()
        return cut.withColumn("item_templates", F.transform("item_tokens", template))

    as_templates = read(False, tokens_of(F.col("text")), template_of, LEAST_TOKENS)
    return as_templates.unionByName(read(True, words_of(F.col("text")), word_template_of, 1))


def _key(folded: Column, tokens: Column | str, templates: Column | str, at: Column) -> Column:
    """Hash of the window at a place: of its templates, or of its values if it has few literal words."""
    window = F.slice(templates, at, WINDOW)
    literal = window
    for slot in ("<name>", "<number>", "<quantity>"):
        literal = F.array_remove(literal, slot)
    values = F.xxhash64(folded, F.lit("values"), F.slice(tokens, at, WINDOW))
    return F.when(F.size(literal) >= LITERALS, F.xxhash64(folded, window)).otherwise(values)


def _places(tokens: str, length: int, stride: int = 1) -> Column:
    """Places of a row's windows; none if it is shorter than one."""
    places = F.sequence(F.lit(1), F.size(tokens) - (length - 1), F.lit(stride))
    return F.when(F.size(tokens) >= length, places).otherwise(F.array().cast("array<int>"))


def _windows(items: DataFrame) -> DataFrame:
    long = items.where(F.size("item_tokens") >= WINDOW + STRIDE - 1)
    placed = long.select("*", F.explode(_places("item_tokens", WINDOW)).alias("at"))
    key = _key(F.col("folded"), "item_tokens", "item_templates", F.col("at"))
    return placed.select("item_id", "folded", "at", key.alias("window")).distinct()


def _matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, folded, shift) where a window of the document equals one of the item at that shift."""
    # Written: the join is then planned by the true size of the windows, broadcast if they are few.
    windows = written(_windows(items), "template-windows")
    cut = docs.select("doc_id", tokens_of(F.col("text")).alias("tokens"), words_of(F.col("text")).alias("words"))
    cut = cut.withColumns(
        {"templates": F.transform("tokens", template_of), "word_templates": F.transform("words", word_template_of)}
    )

    def own(folded: bool, tokens: str, templates: str) -> Column:
        return F.transform(
            _places(tokens, WINDOW, STRIDE),
            lambda at: F.struct(_key(F.lit(folded), tokens, templates, at).alias("window"), at.alias("doc_at")),
        )

    # The array of windows is a generator's input, so it is made once per document.
    both = F.concat(own(False, "tokens", "templates"), own(True, "words", "word_templates"))
    exploded = cut.select("doc_id", F.inline(both))
    found = (
        exploded.join(windows, "window")
        .select("doc_id", "item_id", "folded", (F.col("doc_at") - F.col("at")).alias("shift"))
        .distinct()
    )
    short = items.where(F.col("folded") & (F.size("item_tokens") < WINDOW + STRIDE - 1))
    short = short.select("item_id", F.size("item_tokens").alias("n"), F.xxhash64("item_tokens").alias("window"))
    # At most one length for each number of words below a common run that is always found.
    for n in sorted(r["n"] for r in short.select("n").distinct().collect()):
        whole = F.transform(
            _places("words", n), lambda at: F.struct(F.xxhash64(F.slice("words", at, n)).alias("window"), at.alias("at"))
        )
        hits = docs.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", F.inline(whole))
        hits = hits.join(written(short.where(F.col("n") == n), "template-short"), "window")
        # One place convicts, however often a document says a short item.
        place = hits.groupBy("doc_id", "item_id").agg((F.min("at") - 1).alias("shift"))
        found = found.unionByName(place.withColumn("folded", F.lit(True)))
    return found


def _longest_run(equal: Column) -> Column:
    """Struct (best, end) of the longest run of true values; end is 1-based."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("at"), F.lit(0).alias("best"), F.lit(0).alias("end"))

    def step(state: Column, hit: Column) -> Column:
        now = F.when(hit, state["now"] + 1).otherwise(0)
        better = now > state["best"]
        return F.struct(
            now.alias("now"),
            (state["at"] + 1).alias("at"),
            F.when(better, now).otherwise(state["best"]).alias("best"),
            F.when(better, state["at"] + 1).otherwise(state["end"]).alias("end"),
        )

    return F.aggregate(equal, start, step, lambda state: F.struct(state["best"].alias("best"), state["end"].alias("end")))


def _consistent_run(marks: str, need: Column) -> tuple[Column, Column, Column]:
    """Three steps to the longest run of equal marks with consistent slots, at least half of it literal words.

    The place after which a run may begin, for each place it may end at; literal words less slots up to each
    place; and from both a struct (best, end), best 0 if there is no run of ``need``.
    """

    def barrier(mark: Column) -> Column:
        other = F.filter(
            "slots",
            lambda s: (s["at"] < mark["at"])
            & (s["kind"] == mark["kind"])
            & (s["want"] == mark["want"])
            & (s["got"] != mark["got"]),
        )
        last = F.coalesce(F.array_max(F.transform(other, lambda s: s["at"])), F.lit(0))
        return F.when(~mark["equal"], mark["at"]).when(mark["slot"], last).otherwise(0)

    def running(values: Column, step) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(values, start, lambda out, v: F.concat(out, F.array(step(F.element_at(out, -1), v))))

    after = running(F.transform(marks, barrier), F.greatest)
    balance = running(F.transform(marks, lambda m: F.when(m["slot"], -1).otherwise(1)), lambda a, v: a + v)

    def ending(end: Column) -> Column:
        low = F.element_at("after", end + 1)
        before = F.slice("balance", low + 1, F.greatest(end - need + 1 - low, F.lit(0)))
        place = F.array_position(F.transform(before, lambda v: v <= F.element_at("balance", end + 1)), True).cast("int")
        best = F.when(place > 0, end - low - place + 1).otherwise(0)
        return F.struct(best.alias("best"), end.alias("end"))

    return after, balance, F.array_max(F.transform(F.sequence(need, F.size(marks)), ending))


def contaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """Pairs of a document and a benchmark item it holds: doc_id, item_id, run, item_tokens, slots, replaced.

    Reads ``doc_id`` and ``text`` of ``docs``, ``item_id`` and ``text`` of ``benchmark``. run is the length of
    the longest run of equal tokens with consistent slots at one offset, at least ``run`` or the whole item;
    slots counts the placeholders in it and replaced those whose value differs from the item's, 0 for a copy
    as it stands. At least half of a run with new values are literal words; a copy as it stands may be all
    slots. Each pair comes once, with the run that covers most of the item.

    A value given two others breaks a run with new values there; what is left on either side counts like any
    other run, also in a document that lines up with the whole item.

    Items of fewer than 8 tokens are found as they stand only. Items without words or item_id and NULL texts
    match nothing. Rows without doc_id are not judged. Rows of one doc_id count as one document; equal items
    each get their pairs. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    items = written(_items(benchmark), "template-items")
    found = written(_matches(docs, items), "template-matches")

    def aligned(tokens: str) -> Column:
        """The document's tokens beside the item's, with NULL where the document ends."""
        return F.transform(
            F.sequence(F.lit(1), F.size("item_tokens")),
            lambda at: F.try_element_at(F.col(tokens), F.when(F.col("shift") + at > 0, F.col("shift") + at)),
        )

    def once(df: DataFrame, **columns: Column) -> DataFrame:
        for name, column in columns.items():
            df = df.withColumn(name, F.explode(F.array(column)))
        return df

    text, folded = F.col("text"), F.col("folded")
    read = F.when(folded, words_of(text)).otherwise(tokens_of(text))
    laid = once(docs.join(found, "doc_id").select("doc_id", "item_id", "folded", "shift", "text"), tokens=read)
    laid = once(laid.drop("text").join(items, ["item_id", "folded"]), beside=aligned("tokens")).drop("tokens")

    def mark(p: Column, i: Column) -> Column:
        got = F.when(folded, word_template_of(p["got"])).otherwise(template_of(p["got"]))
        equal = F.coalesce(p["kind"] == got, F.lit(False))
        return F.struct(
            (i + 1).alias("at"), p["kind"], p["want"], p["got"], equal.alias("equal"), _is_slot(p["kind"]).alias("slot")
        )

    zipped = F.arrays_zip(
        F.col("item_templates").alias("kind"), F.col("item_tokens").alias("want"), F.col("beside").alias("got")
    )
    size = F.size("item_tokens")
    need = F.least(F.lit(run), size)
    laid = once(laid, marks=F.transform(zipped, mark))
    whole = once(laid, whole=_longest_run(F.transform("marks", lambda m: m["equal"]))["best"]).where(F.col("whole") >= need)
    whole = once(whole, slots=F.filter("marks", lambda m: m["slot"] & m["equal"]))

    as_it_stands = _longest_run(F.transform("marks", lambda m: m["equal"] & (m["want"] == m["got"])))
    after, balance, new_values = _consistent_run("marks", need)
    judged = once(whole, exact=as_it_stands, after=after, balance=balance, filled=new_values)
    runs = F.filter(
        F.array(F.col("exact"), F.when(size >= LEAST_TOKENS, F.col("filled"))),
        lambda r: r["best"] >= need,
    )
    judged = judged.select("doc_id", "item_id", "item_tokens", "slots", F.explode(runs).alias("found"))
    held = F.filter(
        "slots", lambda s: (s["at"] > F.col("found.end") - F.col("found.best")) & (s["at"] <= F.col("found.end"))
    )
    judged = once(judged, pairs=held).select(
        "doc_id",
        "item_id",
        F.col("found.best").alias("run"),
        size.alias("item_tokens"),
        F.size("pairs").alias("slots"),
        F.size(F.filter("pairs", lambda p: p["want"] != p["got"])).alias("replaced"),
    )
    covered = F.struct(F.col("run") / F.col("item_tokens"), -F.col("replaced"), F.col("run"))
    best = F.max_by(F.struct("run", "item_tokens", "slots", "replaced"), covered)
    return judged.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with their columns as they are; rows without doc_id stay."""
    hit = written(contaminated(docs, benchmark, run).select(F.col("doc_id").alias("_hit")).distinct(), "template-hits")
    return docs.join(hit, docs["doc_id"] == hit["_hit"], "left_anti")
