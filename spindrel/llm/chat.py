"""Preference formatting of chosen and rejected conversations, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def _rendered(turns: str) -> str:
    return f"array_join(transform({turns}, x -> x.block), '')"


def _mask(turns: str, roles: str) -> str:
    """Spans start:end, in code points of the rendered turns, that count for the loss: the
    text and end mark of turns by `roles`."""
    step = (
        "(acc, x) -> named_struct('at', acc.at + length(x.block), 'spans', "
        f"if(x.role in ({roles}), array_append(acc.spans, concat(acc.at + length(x.block) - length(x.body), ':', acc.at + length(x.block) - 1)), acc.spans))"
    )
    return f"array_join(aggregate({turns}, named_struct('at', 0, 'spans', cast(array() as array<string>)), {step}).spans, ',')"


def preference_pairs(turns: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(pair_id, n_chosen, n_rejected, n_common, prompt, chosen, rejected, chosen_mask,
    rejected_mask) per pair of `turns` (pair_id, is_chosen, turn, role, text).

    The longest common prefix of turns, equal in role and text, is rendered once as prompt;
    chosen and rejected are the rest of either conversation. Masks list the code-point spans
    start:end of a completion that count for the loss: texts and end marks of roles in
    `learn`. Turns are ordered by turn, then role and text where turns tie; repeated rows
    are turns of their own. A null role or text counts as '', a null turn comes first. A
    pair without one side has an empty completion there. Rows without pair_id or is_chosen
    are left out; other columns are ignored; an empty table gives an empty result. All
    turns of one pair meet in one row, as its result does."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    body = F.concat(text, F.lit(END))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), body.alias("body"), F.concat(F.lit(START), role, F.lit("\n"), body).alias("block"))
    rows = turns.where("pair_id is not null and is_chosen is not null")

    def side(which: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(which, turn)))

    pairs = rows.groupBy("pair_id").agg(side(F.col("is_chosen")).alias("c"), side(~F.col("is_chosen")).alias("r"))
    same = "transform(c, (x, i) -> i < size(r) and x.role = try_element_at(r, i + 1).role and x.body = try_element_at(r, i + 1).body)"
    pairs = pairs.withColumn("n_common", F.expr(f"cast(case when array_position({same}, false) = 0 then size(c) else array_position({same}, false) - 1 end as int)"))
    pairs = pairs.withColumn("p", F.expr("slice(c, 1, n_common)")).withColumn("x", F.expr("slice(c, n_common + 1, size(c))")).withColumn("y", F.expr("slice(r, n_common + 1, size(r))"))
    roles = ", ".join("'" + x.replace("'", "\\'") + "'" for x in learn)
    return pairs.select(
        "pair_id",
        F.size("c").cast("long").alias("n_chosen"),
        F.size("r").cast("long").alias("n_rejected"),
        F.col("n_common").cast("long").alias("n_common"),
        F.expr(_rendered("p")).alias("prompt"),
        F.expr(_rendered("x")).alias("chosen"),
        F.expr(_rendered("y")).alias("rejected"),
        F.expr(_mask("x", roles)).alias("chosen_mask"),
        F.expr(_mask("y", roles)).alias("rejected_mask"),
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Pairs out of plain conversations: conversation 2k as chosen, 2k + 1 as rejected.

    Turns of a null conversation have no pair; null turns, roles and texts stay null; repeated
    rows stay; other columns are left out; an empty table gives an empty result."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(F.floor(conv / 2).cast("long").alias("pair_id"), (F.pmod(conv, F.lit(2)) == 0).alias("is_chosen"), "turn", "role", "text")


NEIGHBOURS_SQL = """
with t as (
  select cast(floor(conv_id / 2) as bigint) as pair_id, conv_id % 2 = 0 as is_chosen, turn, coalesce(role, '') as role,
         coalesce(text, '') || '<|im_end|>' || chr(10) as body from conversations where conv_id is not null),
o as (select *, row_number() over (partition by pair_id, is_chosen order by turn nulls first, role, body) as pos,
      '<|im_start|>' || role || chr(10) || body as block from t),
ids as (select pair_id, cast(count(*) filter (is_chosen) as bigint) as n_chosen, cast(count(*) filter (not is_chosen) as bigint) as n_rejected from o group by pair_id),
bad as (
  select c.pair_id, min(c.pos) as pos from (select * from o where is_chosen) c
  left join (select * from o where not is_chosen) r on c.pair_id = r.pair_id and c.pos = r.pos
  where r.pos is null or r.role <> c.role or r.body <> c.body group by c.pair_id),
n as (select ids.*, coalesce(bad.pos - 1, n_chosen) as n_common from ids left join bad using (pair_id)),
x as (select o.*, n.n_common, coalesce(sum(length(block)) over (partition by o.pair_id, is_chosen, pos > n_common order by pos rows between unbounded preceding and 1 preceding), 0) as lead_in
      from o join n on o.pair_id = n.pair_id),
g as (
  select pair_id,
    coalesce(string_agg(block, '' order by pos) filter (is_chosen and pos <= n_common), '') as prompt,
    coalesce(string_agg(block, '' order by pos) filter (is_chosen and pos > n_common), '') as chosen,
    coalesce(string_agg(block, '' order by pos) filter (not is_chosen and pos > n_common), '') as rejected,
    coalesce(string_agg(cast(lead_in + length(block) - length(body) as bigint) || ':' || cast(lead_in + length(block) - 1 as bigint), ',' order by pos) filter (is_chosen and pos > n_common and role = 'assistant'), '') as chosen_mask,
    coalesce(string_agg(cast(lead_in + length(block) - length(body) as bigint) || ':' || cast(lead_in + length(block) - 1 as bigint), ',' order by pos) filter (not is_chosen and pos > n_common and role = 'assistant'), '') as rejected_mask
  from x group by pair_id)
select pair_id, n_chosen, n_rejected, cast(n_common as bigint) as n_common, prompt, chosen, rejected, chosen_mask, rejected_mask from n join g using (pair_id)
"""
