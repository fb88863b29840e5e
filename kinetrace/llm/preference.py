"""Preference formatting: a shared prompt and two masked completions for each pair of conversations.

DataFrame functions only. A pair's turns meet in one group; the longest
common prefix of turns (equal role and text) is rendered once as the prompt,
and what follows in each conversation becomes a completion whose mask lists the
code points that count for the loss: the text and end mark of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks around a turn, and the role that is trained.
HEAD, MID, END, TRAINED = "<|", "|>\n", "<|end|>\n", "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), F.coalesce(turn["role"], F.lit("")), F.lit(MID))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    """All turns as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """``start:end`` of the trained code points in the rendered turns, joined by commas."""
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(_body(t))
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, empty, step, lambda acc: F.array_join(acc["out"], ","))


def _turn(turn_col: str, role_col: str, text_col: str) -> Column:
    return F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))


def format_pairs(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "side", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formats pairs from turns whose ``side_col`` is ``chosen`` or ``rejected``; see :func:`formatted`.

    Turns stand in order of number, role and text, so repeated numbers have a
    defined place; a null number comes first. A pair that lacks a side has no
    prompt and an empty completion there. Rows with a null pair or another side
    are left out. A group is one pair of conversations, never more.
    """
    rows = turns.where(F.col(pair_col).isNotNull() & F.col(side_col).isin("chosen", "rejected")).select(F.col(pair_col).alias("pair_id"), F.col(side_col).alias("side"), _turn(turn_col, role_col, text_col).alias("t"))
    of = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("t"))))
    return formatted(rows.groupBy("pair_id").agg(of("chosen").alias("c"), of("rejected").alias("r")))


def formatted(pairs: DataFrame) -> DataFrame:
    """Formats pairs (pair_id, arrays of turns c and r: chosen and rejected).

    Returns for each pair: ``pair_id``, ``n_prompt_turns``, ``n_chosen_turns``
    and ``n_rejected_turns`` (after the prompt), ``prompt``, ``chosen``,
    ``rejected``, their masks, and ``usable`` (both completions have a trained
    turn). Null roles and texts are rendered as empty and equal each other.
    """
    same = F.zip_with("c", "r", lambda a, b: F.coalesce(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]) & a.isNotNull() & b.isNotNull(), F.lit(False)))
    first_other = F.array_position(same, F.lit(False))
    pairs = pairs.withColumn("n", F.when(first_other > 0, first_other - 1).otherwise(F.size(same)).cast("int"))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    pairs = pairs.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    trained = lambda c: F.exists(c, lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))
    return pairs.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt_turns"),
        F.size("c").cast("long").alias("n_chosen_turns"),
        F.size("r").cast("long").alias("n_rejected_turns"),
        render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        mask(F.col("c")).alias("chosen_mask"),
        render(F.col("r")).alias("rejected"),
        mask(F.col("r")).alias("rejected_mask"),
        (trained("c") & trained("r")).alias("usable"),
    )


def shared_prompts(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pairs (pair_id, c, r) for a table without preferences, one for each conversation.

    Chosen is a conversation up to its last assistant turn. Rejected has the
    same turns before that one, and then the last assistant turn of the
    conversation beside it (2k and 2k + 1 are beside each other), or nothing
    where there is none. A conversation without an assistant turn is all
    prompt. Turns stand in order of number, role and text; rows with a null id
    are left out. Both conversations meet in one shuffle. Ids have to be whole
    numbers, which tell which conversations are beside each other; others raise
    a TypeError.
    """
    if not isinstance(conversations.schema[id_col].dataType, (T.IntegralType, T.NullType)):
        raise TypeError(f"{id_col} has to hold whole numbers, not {conversations.schema[id_col].dataType.simpleString()}")
    number = F.col(id_col).cast("long")
    rows = conversations.where(number.isNotNull()).select(F.shiftright(number, 1).alias("k"), number.bitwiseAND(F.lit(1)).alias("odd"), _turn(turn_col, role_col, text_col).alias("t"))
    of = lambda odd: F.array_sort(F.collect_list(F.when(F.col("odd") == odd, F.col("t"))))
    both = rows.groupBy("k").agg(of(0).alias("a"), of(1).alias("b"))
    last = lambda c: F.size(c) + 1 - F.array_position(F.reverse(F.transform(c, lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))), F.lit(True)).cast("int")
    both = both.withColumns({"last_a": last("a"), "last_b": last("b")})  # one beyond the end where there is none

    def side(odd: int, own: str, other: str) -> Column:
        n, m = F.col(f"last_{own}"), F.col(f"last_{other}")
        prompt = F.slice(own, F.lit(1), n - 1)
        answer = F.when(m <= F.size(other), F.slice(other, m, F.lit(1))).otherwise(F.slice(other, F.lit(1), F.lit(0)))
        return F.struct((F.shiftleft("k", 1) + odd).alias("pair_id"), F.slice(own, F.lit(1), F.least(n, F.size(own))).alias("c"), F.concat(prompt, answer).alias("r"), (F.size(own) > 0).alias("there"))

    return both.select(F.explode(F.array(side(0, "a", "b"), side(1, "b", "a"))).alias("p")).select("p.*").where("there").drop("there")


_TURN = "'<|' || coalesce(t.role, '') || '|>\n' || coalesce(t.text, '') || '<|end|>\n'"


def _sql_mask(turns: str) -> str:
    before = f"coalesce(list_sum(list_transform(range(1, i), lambda k: CAST(length(coalesce({turns}[k].role, '')) + length(coalesce({turns}[k].text, '')) + 13 AS BIGINT))), 0)"
    start = f"CAST({before} AS BIGINT) + length(coalesce({turns}[i].role, '')) + 5"
    return (
        f"array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {turns}[i].role = 'assistant'), "
        f"lambda i: CAST({start} AS VARCHAR) || ':' || CAST({start} + length(coalesce({turns}[i].text, '')) + 8 AS VARCHAR)), ',')"
    )


#: DuckDB SQL for :func:`formatted` of :func:`shared_prompts` over ``conversations``.
ORACLE = f"""
WITH convs AS (
  SELECT conv_id, list({{'turn': turn, 'role': role, 'text': text}} ORDER BY turn, role, text) AS l FROM conversations GROUP BY conv_id
), ends AS (
  SELECT conv_id, l, coalesce(list_max(list_filter(range(1, len(l) + 1), lambda i: l[i].role = 'assistant')), len(l) + 1) AS n FROM convs
), pairs AS (
  SELECT x.conv_id AS pair_id, x.l[1:x.n] AS c, list_concat(x.l[1:x.n - 1], coalesce(y.l[y.n:y.n], [])) AS r FROM ends x LEFT JOIN ends y ON y.conv_id = xor(x.conv_id, 1)
), cut AS (
  SELECT pair_id, c, r, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1),
         lambda i: c[i].role IS DISTINCT FROM r[i].role OR c[i].text IS DISTINCT FROM r[i].text)) - 1, least(len(c), len(r))) AS n FROM pairs
), done AS (
  SELECT pair_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM cut
)
SELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(n AS BIGINT) AS n_prompt_turns, CAST(len(c) AS BIGINT) AS n_chosen_turns, CAST(len(r) AS BIGINT) AS n_rejected_turns,
  coalesce(array_to_string(list_transform(p, lambda t: {_TURN}), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(c, lambda t: {_TURN}), ''), '') AS chosen, coalesce({_sql_mask('c')}, '') AS chosen_mask,
  coalesce(array_to_string(list_transform(r, lambda t: {_TURN}), ''), '') AS rejected, coalesce({_sql_mask('r')}, '') AS rejected_mask,
  len(list_filter(c, lambda t: t.role = 'assistant')) > 0 AND len(list_filter(r, lambda t: t.role = 'assistant')) > 0 AS usable
FROM done
"""
