"""Chat formatting with SQL functions only: turns as structs, runs of one role as blocks, a loss mask.

    <|im_start|>role\\ntext<|im_sep|>text of the next turn of that role<|im_end|>\\n

Turns of a conversation are collected as structs and sorted; adjacent turns of one role become one
block. Control strings inside texts are escaped, so a formatted conversation gives back its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
# A control string begins with these two characters; inside texts a backslash more stands between them.
_OPEN, _SHUT = (r"<(\\*)\|", r"<\\$1|"), (r"<\\(\\*)\|", "<$1|")
# Running sums of an array are taken in stretches of this length.
STRETCH = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, *_OPEN)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, *_SHUT)


def _parted(text: Column, mark: str) -> Column:
    return F.split(text, mark.replace("|", r"\|"), -1)


def _numbers(count: Column) -> Column:
    """0 to count - 1."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)


def before(lengths: Column) -> Column:
    """Of each entry of an array, the sum of those before it."""
    stretches = F.transform(
        _numbers(F.ceil(F.size(lengths) / STRETCH)), lambda k: _total(F.slice(lengths, k * STRETCH + 1, STRETCH))
    )
    # The few sums of whole stretches are added up one by one.
    heads = F.aggregate(
        stretches,
        F.array(F.lit(0).cast("long")),
        lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)),
    )
    packed = F.struct(lengths.alias("each"), heads.alias("heads"))
    return F.element_at(
        F.transform(
            F.array(packed),
            lambda p: F.transform(
                _numbers(F.size(p["each"])),
                lambda i: F.get(p["heads"], F.floor(i / STRETCH).cast("int"))
                + _total(F.slice(p["each"], F.floor(i / STRETCH).cast("int") * STRETCH + 1, i % STRETCH)),
            ),
        ),
        1,
    )


def format_conversations(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, formatted, mask): each conversation as one text, and the spans that a loss is taken on.

    ``conversations`` has conv_id, turn, role and text; other columns are ignored, whatever their names.
    Turns come by number, those without one last; equal numbers by role, then text; repeated rows stay.
    A null text or role is an empty one. Rows without conv_id form one conversation. An empty table gives
    none. ``mask`` lists, for every turn of the role ``trained``, its block's number, where the block begins
    and where the turn's escaped text begins and ends, in code points of ``formatted``.

    Rows of a conversation are gathered on the map side first; one conversation is one row, as its text is.
    Work is in proportion to its length, but for a block of very many merged turns.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # A block begins where the role changes.
    begins = F.filter(
        _numbers(F.size("turns")),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    runs = sorted_turns.select("conv_id", "turns", begins.alias("begins"))

    def block(begin: Column, k: Column) -> Column:
        after = F.coalesce(F.get("begins", k + 1), F.size("turns"))
        merged = F.slice("turns", begin + 1, after - begin)
        return F.struct(
            F.get("turns", begin)["role"].alias("role"),
            F.transform(merged, lambda t: escaped(t["text"])).alias("texts"),
        )

    blocks = runs.select("conv_id", F.transform("begins", block).alias("blocks"))
    head = lambda b: F.concat(F.lit(START), F.replace(escaped(b["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    whole = F.transform(
        "blocks",
        lambda b: F.struct(
            b["role"].alias("role"),
            F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(f"{END}\n")).alias("block"),
            F.char_length(head(b)).cast("long").alias("head"),
            F.transform(b["texts"], lambda t: F.char_length(t).cast("long")).alias("sizes"),
        ),
    )
    whole = blocks.select("conv_id", whole.alias("blocks"))
    placed = whole.select(
        "conv_id",
        "blocks",
        F.array_join(F.transform("blocks", lambda b: b["block"]), "").alias("formatted"),
        before(F.transform("blocks", lambda b: F.char_length(b["block"]).cast("long"))).alias("places"),
    )

    def spans(k: Column) -> Column:
        b, place = F.get("blocks", k), F.get("places", k)

        def span(size: Column, i: Column) -> Column:
            begin = place + b["head"] + _total(F.slice(b["sizes"], 1, i)) + i * len(SEP)
            return F.struct(k.alias("block"), place.alias("place"), begin.alias("begin"), (begin + size).alias("end"))

        return F.transform(b["sizes"], span)

    asked = F.filter(_numbers(F.size("blocks")), lambda k: F.get("blocks", k)["role"] == trained)
    return placed.select("conv_id", "formatted", F.flatten(F.transform(asked, spans)).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss) of formatted conversations: their turns (role, text), and the texts under the mask.

    Extra columns are left out. A conversation without turns has empty arrays.
    """
    parts = _parted(F.col("formatted"), START)
    cut = formatted.select(
        "conv_id", "formatted", "mask", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias("blocks")
    )

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        size = F.char_length(block) - F.char_length(role) - 1 - len(END) - 1
        body = F.substring(block, F.char_length(role) + 2, size)
        name = unescaped(F.replace(role, F.lit(LINE), F.lit("\n")))
        return F.transform(
            _parted(body, SEP), lambda text: F.struct(name.alias("role"), unescaped(text).alias("text"))
        )

    def under(span: Column) -> Column:
        at = span["begin"] - span["place"] - len(START) + 1
        return unescaped(F.substring(F.get("blocks", span["block"]), at, span["end"] - span["begin"]))

    return cut.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform("blocks", turns)).alias("turns"),
        F.transform("mask", under).alias("loss"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations give back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(lines).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        sha(loss).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def oracle(extra: list[tuple[int, int, str, str]]) -> str:
    """SQL for the digests of the table ``conversations`` and some further rows."""
    rows = " union all ".join(f"select {c}, {t}, '{r}', '{x}'" for c, t, r, x in extra)
    esc = lambda c: f"regexp_replace({c}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    return f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all {rows}
), o as (
  select *, lag(role) over w as last_role from t window w as (partition by conv_id order by turn nulls last, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({esc('text')}) + case when role = last_role then {len(SEP)}
    else {len(START) + 1 + len(END) + 1} + length({esc('role')}) + {len(LINE) - 1} * (length(role) - length(replace(role, chr(10), ''))) end) as bigint) as formatted_chars
from o group by conv_id"""
