r"""Conversations as training text: a finite-state machine over roles, a declarative template, loss flags.

A template says how a turn is written: a header that names the role, the text, an end mark, which
roles are learned from, and which role may follow which. Each turn gives three segments, header,
text and end mark; only the text of a learned role is under the loss. Control strings (a header or
an end mark) inside a text get a backslash in their middle, one more if some are there already, so
no text can open or close a turn, every other text stays as it is, and reading takes the same
backslash out again. ``read_back`` recovers roles, texts and learned texts from the output alone.

The machine starts in ``start`` and folds over the roles in order; a move that the template does
not list ends in ``REJECTED``. Its verdict is ``valid`` and ``bad_turn``, the first turn that may
not stand where it does; ``formatted`` keeps every conversation, and ``valid_only`` drops what the
machine rejects.

SQL functions only. A conversation is one row of the result, so it must fit a row; its rows are
gathered in one shuffle.

Defined results: rows are ordered by turn, then role, then text, nulls first, so ties and repeated
rows have one order; repeated rows are turns of their own; a null text is empty; a null role is the
empty role; roles that the template does not name are written percent-encoded and are neither
learned nor allowed; a null conv_id is a conversation of its own; an empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REJECTED = "rejected"


@dataclass(frozen=True)
class Template:
    """How turns are written, and which orders of roles are valid."""

    #: Written name of each role, letters only.
    names: Mapping[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    mark: str = "###"
    end: str = "</turn>"
    learned: tuple[str, ...] = ("assistant",)
    #: Roles that may follow a role; ``start`` stands before the first turn.
    follows: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    #: Roles that a conversation may end with.
    last: tuple[str, ...] = ("assistant",)

    @property
    def header_name(self) -> str:
        """Pattern of the name in a header; names unknown to the template follow an ``@``."""
        return f"(?:{'|'.join(self.names.values())}|@[^\\x00-\\x20:]*)"

    def controls(self, slashes: str) -> str:
        """Pattern of a header or an end mark with ``slashes`` in its middle; groups 1 to 3 or 4 to 6."""
        mark, first, rest = map(_quoted, (self.mark, self.end[0], self.end[1:]))
        return f"({mark})({slashes})( {self.header_name}: )|({first})({slashes})({rest})"


def _quoted(text: str) -> str:
    """``text`` as a pattern that Java and RE2 read alike."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def escaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, template.controls(r"\\*"), r"$1$2$4$5\\$3$6")


def unescaped(text: Column, template: Template) -> Column:
    one_less = template.controls(r"\\*").replace(r"(\\*)", r"\\(\\*)")
    return F.regexp_replace(text, one_less, "$1$2$3$4$5$6")


def _chosen(key: Column, values: Mapping[str, str], otherwise: Column) -> Column:
    for name, value in values.items():
        otherwise = F.when(key == name, value).otherwise(otherwise)
    return otherwise


def written_name(role: Column, template: Template) -> Column:
    return _chosen(role, template.names, F.concat(F.lit("@"), F.url_encode(role)))


def _turn_segments(turn: Column, template: Template) -> Column:
    """Header, escaped text and end mark of a turn, each with its loss flag."""
    learned = turn["role"].isin(list(template.learned))
    parts = (
        (F.concat(F.lit(f"{template.mark} "), written_name(turn["role"], template), F.lit(": ")), F.lit(False)),
        (escaped(turn["text"], template), learned),
        (F.lit(f"{template.end}\n"), F.lit(False)),
    )
    return F.array(*(F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts))


def _machine(roles: Column, template: Template) -> Column:
    """State after the last turn and number of the first turn that may not stand there (0: none)."""
    moves = F.create_map(*(F.lit(x) for a, roles_after in template.follows.items() for b in roles_after for x in (f"{a} {b}", b)))

    def step(state: Column, role: Column) -> Column:
        after = F.coalesce(F.try_element_at(moves, F.concat_ws(" ", state["at"], role)), F.lit(REJECTED))
        at = state["turn"] + 1
        bad = F.when((state["bad"] == 0) & (after == REJECTED), at).otherwise(state["bad"])
        return F.struct(after.alias("at"), at.alias("turn"), bad.alias("bad"))

    start = F.struct(F.lit("start").alias("at"), F.lit(0).alias("turn"), F.lit(0).alias("bad"))
    return F.aggregate(roles, start, step)


def formatted(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, segments, formatted, valid, bad_turn) of turns (conv_id, turn, role, text).

    ``segments`` are (text, loss) in order; joined they are ``formatted``.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    machine = gathered.withColumn("_state", _machine(F.col("_turns.role"), template))
    ends = F.col("_state.at").isin(list(template.last))
    # A valid order that ends too early is bad where the next turn should have been.
    bad = F.when(F.col("_state.bad") > 0, F.col("_state.bad")).when(~ends, F.col("_state.turn") + 1).otherwise(0)
    return machine.select(
        "conv_id",
        F.flatten(F.transform("_turns", lambda t: _turn_segments(t, template))).alias("segments"),
        (bad == 0).alias("valid"),
        bad.alias("bad_turn"),
    ).select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"), "valid", "bad_turn")


def valid_only(conversations: DataFrame) -> DataFrame:
    return conversations.where("valid")


def read_back(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns``, the (role, text) of each turn out of ``formatted``, and ``learned``, the texts under
    the loss out of ``segments``, unescaped."""
    pieces = F.split("formatted", _quoted(f"{template.end}\n"))
    header = f"(?s)^{_quoted(template.mark)} ({template.header_name}): (.*)$"
    roles = {name: role for role, name in template.names.items()}

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, header, 1)
        role = _chosen(name, roles, F.url_decode(F.substr(name, F.lit(2))))
        return F.struct(role.alias("role"), unescaped(F.regexp_extract(piece, header, 2), template).alias("text"))

    whole = F.filter(pieces, lambda p: p != "")
    under_loss = F.filter("segments", lambda s: s["loss"])
    return conversations.withColumns(
        {"turns": F.transform(whole, turn), "learned": F.transform(under_loss, lambda s: unescaped(s["text"], template))}
    )


#: A conversation whose texts hold control strings and the escape character.
PROBE = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("CAST(conv_id AS long)", "CAST(turn AS long)", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    found = read_back(formatted(turns.unionByName(probe)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "bad_turn",
    )


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(i, r)),
w AS (
  SELECT *, CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
                      ELSE '@' || replace(url_encode(role), '%20', '+') END AS name,
         regexp_replace(text, '(###)(\\*)( (System|User|Assistant|@[^\x00-\x20:]*): )|(<)(\\*)(/turn>)',
                        '\1\2\5\6\\\3\7', 'g') AS written,
         CASE WHEN lag(role) OVER o IS NULL THEN role IN ('system', 'user')
              WHEN lag(role) OVER o IN ('system', 'assistant') THEN role = 'user'
              ELSE lag(role) OVER o = 'user' AND role = 'assistant' END AS may,
         row_number() OVER o AS place
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
         CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
         CAST(sum(length('### ' || name || ': ' || written || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars,
         coalesce(min(place) FILTER (NOT may), CASE WHEN arg_max(role, place) = 'assistant' THEN 0 ELSE count(*) + 1 END) AS bad
  FROM w GROUP BY conv_id)
SELECT * EXCLUDE (bad), bad = 0 AS valid, CAST(bad AS INTEGER) AS bad_turn FROM c"""
