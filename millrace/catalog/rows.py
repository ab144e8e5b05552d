"""Queries over token lists, batches and the plans that end in training rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.catalog import fragments as q
from millrace.catalog import tables as t
from millrace.catalog.vocabulary import MERGES, full_vocabulary, small_vocabulary
from millrace.functions.render import ChatTemplate, render_human_assistant, render_role_prefix
from millrace.functions.sequences import (
    add_special,
    attention_mask,
    causal_labels,
    pad,
    stop_at,
    truncate,
)
from millrace.operators.batches import (
    assign_batches,
    epoch_order,
    pad_to_batch_max,
    planned_run,
    read_rank,
    run_plan,
    run_points,
    write_ranks,
)
from millrace.operators.conversations import preference_pairs, select_text
from millrace.operators.preference import preference_tokens
from millrace.plans.training_rows import (
    adapter_rows,
    batched_rows,
    fine_tuning_rows,
    preference_batches,
    preference_rows,
    pretrain_batches,
    pretrain_rows,
    special_ids,
)
from millrace.session import checkpoint_dir
from millrace.sources.jsonl import read_jsonl

# The space between words serves as pad id where pad and content must meet.
SPACE, NEWLINE, PAD = 32, 10, 2
LENGTH = 512


def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.document_bytes(spark, sf_dir).select("doc_id", truncate(F.col("ids"), LENGTH).alias("ids"))
    return rows.select("doc_id", t.joined("ids"))


def padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts over the length stay as they are: padding does not cut."""
    ids = F.col("ids")
    rows = t.document_bytes(spark, sf_dir).select(
        "doc_id",
        pad(ids, LENGTH, PAD).alias("ids"),
        attention_mask(ids, LENGTH).alias("attention_mask"),
    )
    return rows.select("doc_id", t.joined("ids"), t.joined("attention_mask"))


def with_bos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.document_bytes(spark, sf_dir)
    return rows.select(
        "doc_id",
        F.array_join(add_special(F.col("ids"), 1, None), " ").alias("ids"),
        F.array_join(add_special(F.col("ids"), 1, 2), " ").alias("ids_with_end"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.document_bytes(spark, sf_dir).select("doc_id", causal_labels(F.col("ids"), SPACE).alias("labels"))
    return rows.select("doc_id", t.joined("labels"))


def stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.document_bytes(spark, sf_dir).select("doc_id", stop_at(F.col("ids"), NEWLINE, 100).alias("ids"))
    return rows.select("doc_id", t.joined("ids"))


def limited_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_pairs(t.preferences(spark, sf_dir), "conv_id", ChatTemplate(), "common_prefix")
    sides = ["prompt", "chosen", "rejected"]
    ids = pairs.select("conv_id", *[t.byte_ids(F.col(side)).alias(side) for side in sides])
    rows = preference_tokens(ids, "conv_id")
    return rows.select("conv_id", *[t.joined(c) for c in rows.columns[1:]])


def padded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = select_text(t.conversations(spark, sf_dir), "conv_id", render_role_prefix)
    ids = texts.select("conv_id", t.byte_ids(F.col("text")).alias("ids"))
    batches = assign_batches(epoch_order(texts, "conv_id", 1, 11), batch=2, accum=16)
    placed = batches.select(F.col("key").alias("conv_id"), "micro").join(ids, "conv_id")
    rows = pad_to_batch_max(placed, ["micro"], "ids", PAD)
    return rows.select("conv_id", "micro", t.joined("ids"), t.joined("attention_mask"))


def batched_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference rows of bytes, laid out over two epochs and four ranks."""
    pairs = preference_pairs(t.preferences(spark, sf_dir), "conv_id", ChatTemplate())
    sides = ["prompt", "chosen", "rejected"]
    ids = pairs.select("conv_id", *[t.byte_ids(F.col(side)).alias(side) for side in sides])
    batched = batched_rows(preference_tokens(ids, "conv_id"), "conv_id", 2, 13, 2, 16, 4)
    rows = preference_batches(batched, PAD)
    lists = [f"{side}_{kind}" for side in ("chosen", "rejected") for kind in ("ids", "labels", "mask")]
    return rows.select("conv_id", "epoch", "pos", "rank", "micro", "step", *[t.joined(c) for c in lists])


def shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epoch_order(t.table(spark, sf_dir, "orders", ["o_orderkey"]), "o_orderkey", 3, 42)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_batches(shuffled(spark, sf_dir), batch=4, accum=8, world=3)


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_plan(batches(spark, sf_dir))


def plan_of_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planned_run(t.table(spark, sf_dir, "orders", ["o_orderkey"]), epochs=3, batch=4, accum=8, world=3)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_points(plan_of_count(spark, sf_dir), logging_steps=10, save_steps=100)


def points_per_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_points(plan_of_count(spark, sf_dir), logging_steps=100)


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.select(rows.columns[0], *[t.joined(c) for c in rows.columns[1:]])


def pretraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = t.documents(spark, sf_dir)
    return _as_text(pretrain_rows(texts, "doc_id", small_vocabulary(texts), PAD, LENGTH))


def fine_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = t.conversations(spark, sf_dir)
    learned = small_vocabulary(select_text(nested, "conv_id", render_role_prefix))
    return _as_text(fine_tuning_rows(nested, "conv_id", learned, PAD, LENGTH))


def adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = t.conversations(spark, sf_dir)
    learned = small_vocabulary(select_text(nested, "conv_id", render_human_assistant))
    return _as_text(adapter_rows(nested, "conv_id", learned, PAD, LENGTH))


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary is learned from what stands between special tokens."""
    rows = t.preferences(spark, sf_dir)
    pairs = preference_pairs(rows, "conv_id", ChatTemplate())
    texts = pairs.select(F.explode(F.array("chosen", "rejected")).alias("text"))
    learned = small_vocabulary(texts.select(F.explode(F.split("text", "<s>|</s>")).alias("text")))
    return _as_text(preference_rows(rows, "conv_id", learned, ChatTemplate()))


def full_pretraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(pretrain_rows(t.documents(spark, sf_dir), "doc_id", full_vocabulary(spark, sf_dir), PAD, LENGTH))


def full_fine_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(fine_tuning_rows(t.conversations(spark, sf_dir), "conv_id", full_vocabulary(spark, sf_dir), PAD, LENGTH))


def full_adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(adapter_rows(t.conversations(spark, sf_dir), "conv_id", full_vocabulary(spark, sf_dir), PAD, LENGTH))


def full_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(preference_rows(t.preferences(spark, sf_dir), "conv_id", full_vocabulary(spark, sf_dir), ChatTemplate()))


#: Examples of a trial run.
TRIAL = 1000


def trial_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSON to batches, with a start token, and the end token for padding."""
    path = f"{checkpoint_dir(spark)}/examples-{uuid4().hex}"
    t.table(spark, sf_dir, "documents", ["doc_id", "text"]).write.json(path)
    examples = read_jsonl(spark, path, "doc_id BIGINT, text STRING")
    learned = small_vocabulary(t.documents(spark, sf_dir))
    settings = spark.createDataFrame([("<s>", "</s>", None, "<unk>")], "bos STRING, eos STRING, pad STRING, unk STRING")
    specials = special_ids(settings, learned.vocab)
    rows = pretrain_batches(examples, "doc_id", learned, specials, TRIAL, LENGTH, 2, 17, 2, 16, 2)
    lists = ["input_ids", "attention_mask", "labels"]
    return rows.select("epoch", "doc_id", "pos", "rank", "micro", "step", *[t.joined(c) for c in lists])


def rank_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as two ranks read them, with the row before in the same file."""
    path = f"{checkpoint_dir(spark)}/ranks-{uuid4().hex}"
    laid_out = assign_batches(epoch_order(t.table(spark, sf_dir, "orders", ["o_orderkey"]), "o_orderkey", 1, 42), 4, 8, 3)
    write_ranks(laid_out, path)
    both = read_rank(spark, path, 0).union(read_rank(spark, path, 2))
    files = both.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id"))
    before = F.lag("pos").over(Window.partitionBy("file").orderBy("id"))
    ordered = F.coalesce(before < F.col("pos"), F.lit(True))
    return files.select("rank", "epoch", "key", "pos", "micro", "step", ordered.alias("in_order"))


_BYTES = f"bytes AS (SELECT doc_id, {q.byte_list('text')} AS ids FROM documents)"
_EPOCHS = q.epoch_rows("orders", "o_orderkey", 3, 42)
_BATCHES = q.batch_rows(_EPOCHS, 4, 8, 3)
_PLAN = (
    "SELECT epoch, count(*) AS n_rows, max(micro) + 1 AS micro_batches, max(step) + 1 AS steps "
    f"FROM ({_BATCHES}) GROUP BY epoch"
)
_STEPS = f"(SELECT sum(steps)::BIGINT AS total FROM ({_PLAN}))"
_CAUSAL = q.causal("ids", LENGTH, PAD)
_CONVERSATION_TEXTS = q.rendered(q.ROLE_PREFIX)
_HUMAN_TEXTS = q.rendered(q.HUMAN_ASSISTANT)


def _every(kind: str, n: int) -> str:
    return f"SELECT '{kind}' AS kind, unnest(range({n}, total + 1, {n})) AS step FROM {_STEPS}"


def _limited_lists(prompt: str, chosen: str, rejected: str, source: str) -> str:
    """Preference token lists: the tail of the prompt, then the head of either side."""

    def side(name: str, column: str) -> str:
        head = f"list_slice({column}, 1, 512 - len(p))"
        return (
            f"list_concat(p, {head}) AS {name}_ids, "
            f"list_concat(list_transform(p, lambda x: -100), {head}) AS {name}_labels"
        )

    kept = f"CASE WHEN len({prompt}) > 256 THEN list_slice({prompt}, len({prompt}) - 255, len({prompt})) ELSE {prompt} END"
    return (
        f"SELECT conv_id, {side('chosen', 'c')}, {side('rejected', 'r')} FROM "
        f"(SELECT conv_id, {kept} AS p, {chosen} AS c, {rejected} AS r FROM {source})"
    )


def _limited(prompt: str, chosen: str, rejected: str, source: str) -> str:
    columns = ["chosen_ids", "chosen_labels", "rejected_ids", "rejected_labels"]
    texts = ", ".join(f"{q.numbers(c)} AS {c}" for c in columns)
    return f"SELECT conv_id, {texts} FROM ({_limited_lists(prompt, chosen, rejected, source)})"


def _filled(side: str) -> str:
    """Lists of one side padded to the longest of their batch."""
    short = f"{side}_longest - len({side}_ids)"

    def fill(column: str, value: int) -> str:
        return q.numbers(f"list_concat({column}, list_transform(range({short}), lambda i: {value}))")

    mask = (
        f"list_concat(list_transform({side}_ids, lambda x: 1), list_transform(range({short}), lambda i: 0))"
    )
    return (
        f"{fill(f'{side}_ids', PAD)} AS {side}_ids, {fill(f'{side}_labels', -100)} AS {side}_labels, "
        f"{q.numbers(mask)} AS {side}_mask"
    )


_PREFERENCE_TEXTS = (
    f"c AS MATERIALIZED ({q.rendered(q.CHAT, 'chosen')}), "
    f"r AS MATERIALIZED ({q.rendered(q.CHAT, 'rejected')})"
)
_PREFERENCE_GAPS = (
    "SELECT unnest(string_split_regex(text, '<s>|</s>')) AS text "
    "FROM (SELECT text FROM c UNION ALL SELECT text FROM r)"
)

QUERIES = {
    "e2_truncate": (
        truncated,
        f"WITH {_BYTES} SELECT doc_id, {q.numbers('list_slice(ids, 1, 512)')} AS ids FROM bytes",
    ),
    "e3_pad": (
        padded,
        f"WITH {_BYTES} SELECT doc_id, "
        f"{q.numbers('list_concat(ids, list_transform(range(greatest(512 - len(ids), 0)), lambda i: 2))')} AS ids, "
        f"{q.numbers('list_concat(list_transform(ids, lambda x: 1), list_transform(range(greatest(512 - len(ids), 0)), lambda i: 0))')} "
        "AS attention_mask FROM bytes",
    ),
    "e6_add_special": (
        with_bos,
        f"WITH {_BYTES} SELECT doc_id, '1 ' || {q.numbers('ids')} AS ids, "
        f"'1 ' || {q.numbers('ids')} || ' 2' AS ids_with_end FROM bytes",
    ),
    "l1_causal_labels": (
        labels,
        f"WITH {_BYTES} SELECT doc_id, "
        f"{q.numbers('list_transform(ids, lambda x: CASE WHEN x = 32 THEN -100 ELSE x END)')} AS labels FROM bytes",
    ),
    "l2_preference_tokens": (
        limited_preferences,
        f"WITH {q.PREFERENCES}, sides AS (SELECT c.conv_id, c.turn, c.role, c.text, r.text AS other, "
        "c.turn < a.last OR c.text = r.text AS same FROM chosen c "
        "JOIN rejected r ON c.conv_id = r.conv_id AND c.turn = r.turn "
        "JOIN answers a ON a.conv_id = c.conv_id), "
        f"lines AS (SELECT conv_id, turn, same, {q.CHAT} AS line, "
        f"{q.CHAT.replace('|| text ||', '|| other ||')} AS other_line FROM sides), "
        "joined AS (SELECT conv_id, coalesce(string_agg(line, '' ORDER BY turn) FILTER (same), '') AS prompt, "
        "coalesce(string_agg(line, '' ORDER BY turn) FILTER (NOT same), '') AS chosen, "
        "coalesce(string_agg(other_line, '' ORDER BY turn) FILTER (NOT same), '') AS rejected "
        "FROM lines GROUP BY conv_id) "
        + _limited(q.byte_list("prompt"), q.byte_list("chosen"), q.byte_list("rejected"), "joined"),
    ),
    "l3_pad_to_batch_max": (
        padded_batches,
        f"WITH texts AS ({_CONVERSATION_TEXTS}), placed AS (SELECT key AS conv_id, micro FROM "
        f"({q.batch_rows(q.epoch_rows('texts', 'conv_id', 1, 11), 2, 16, 1)})), "
        f"ids AS (SELECT conv_id, micro, {q.byte_list('text')} AS ids FROM texts JOIN placed USING (conv_id)), "
        "longest AS (SELECT *, max(len(ids)) OVER (PARTITION BY micro) - len(ids) AS short FROM ids) "
        f"SELECT conv_id, micro, {q.numbers('list_concat(ids, list_transform(range(short), lambda i: 2))')} AS ids, "
        f"{q.numbers('list_concat(list_transform(ids, lambda x: 1), list_transform(range(short), lambda i: 0))')} "
        "AS attention_mask FROM longest",
    ),
    "dpo_batches": (
        batched_preferences,
        f"WITH {q.PREFERENCES}, {_PREFERENCE_TEXTS}, "
        f"sides AS (SELECT conv_id, {q.byte_list('c.text')} AS chosen, {q.byte_list('r.text')} AS rejected "
        "FROM c JOIN r USING (conv_id)), "
        f"lists AS ({_limited_lists('chosen', 'chosen', 'rejected', 'sides')}), "
        f"laid_out AS ({q.batch_rows(q.epoch_rows('lists', 'conv_id', 2, 13), 2, 16, 4)}), "
        "batched AS (SELECT *, max(len(chosen_ids)) OVER w AS chosen_longest, "
        "max(len(rejected_ids)) OVER w AS rejected_longest FROM lists JOIN laid_out ON key = conv_id "
        "WINDOW w AS (PARTITION BY epoch, rank, micro)) "
        f"SELECT conv_id, epoch, pos, rank, micro, step, {_filled('chosen')}, {_filled('rejected')} FROM batched",
    ),
    "g6_stop_at": (
        stopped,
        f"WITH {_BYTES} SELECT doc_id, {q.numbers('list_slice(ids, 1, least(100, coalesce(nullif(list_position(ids, 10), 0), 100)))')} "
        "AS ids FROM bytes",
    ),
    "b1_epoch_order": (shuffled, _EPOCHS),
    "b2_assign_batches": (batches, _BATCHES),
    "b3_run_plan": (
        plan,
        "SELECT *, (sum(steps) OVER (ORDER BY epoch) - steps + 1)::BIGINT AS first_step, "
        f"(sum(steps) OVER (ORDER BY epoch))::BIGINT AS last_step FROM ({_PLAN})",
    ),
    "b3_planned_run": (
        plan_of_count,
        "SELECT *, (sum(steps) OVER (ORDER BY epoch) - steps + 1)::BIGINT AS first_step, "
        f"(sum(steps) OVER (ORDER BY epoch))::BIGINT AS last_step FROM ({_PLAN})",
    ),
    "b3_run_points": (points, f"{_every('log', 10)} UNION ALL {_every('save', 100)}"),
    "b3_run_points_per_epoch": (
        points_per_epoch,
        f"{_every('log', 100)} UNION ALL SELECT 'save' AS kind, "
        f"(sum(steps) OVER (ORDER BY epoch))::BIGINT AS step FROM ({_PLAN})",
    ),
    "pretrain_rows": (
        pretraining,
        f"WITH {q.bpe('SELECT text FROM documents', MERGES)}, "
        f"{q.encoded('e', 'SELECT doc_id, text FROM documents', 'doc_id')} SELECT doc_id, {_CAUSAL} FROM e",
    ),
    "pretrain_rows_6400": (full_pretraining, None),
    "sft_rows_6400": (full_fine_tuning, None),
    "lora_rows_6400": (full_adapters, None),
    "dpo_rows_6400": (full_preferences, None),
    "pretrain_batches": (
        trial_batches,
        f"WITH {q.bpe('SELECT text FROM documents', MERGES)}, "
        f"picked AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {TRIAL}), "
        f"{q.encoded('e', 'SELECT doc_id, text FROM picked', 'doc_id')}, "
        "started AS (SELECT doc_id, list_concat([0], ids) AS ids FROM e), "
        f"laid_out AS ({q.batch_rows(q.epoch_rows('picked', 'doc_id', 2, 17), 2, 16, 2)}) "
        f"SELECT epoch, doc_id, pos, rank, micro, step, {q.causal('ids', LENGTH, 1)} FROM started JOIN laid_out ON key = doc_id",
    ),
    "b2_rank_files": (
        rank_files,
        f"SELECT rank, epoch, key, pos, micro, step, TRUE AS in_order FROM "
        f"({q.batch_rows(q.epoch_rows('orders', 'o_orderkey', 1, 42), 4, 8, 3)}) WHERE rank IN (0, 2)",
    ),
    "sft_rows": (
        fine_tuning,
        f"WITH {q.bpe(_CONVERSATION_TEXTS, MERGES)}, {q.encoded('e', _CONVERSATION_TEXTS, 'conv_id')} "
        f"SELECT conv_id, {_CAUSAL} FROM e",
    ),
    "lora_rows": (
        adapters,
        f"WITH {q.bpe(_HUMAN_TEXTS, MERGES)}, {q.encoded('e', _HUMAN_TEXTS, 'conv_id')} "
        f"SELECT conv_id, {_CAUSAL} FROM e",
    ),
    "dpo_rows": (
        preferences,
        f"WITH {q.PREFERENCES}, {_PREFERENCE_TEXTS}, {q.bpe(_PREFERENCE_GAPS, MERGES)}, "
        f"{q.encoded('ec', 'SELECT conv_id, text FROM c', 'conv_id')}, "
        f"{q.encoded('er', 'SELECT conv_id, text FROM r', 'conv_id')}, "
        "sides AS (SELECT conv_id, ec.ids AS chosen, er.ids AS rejected FROM ec JOIN er USING (conv_id)) "
        + _limited("chosen", "chosen", "rejected", "sides"),
    ),
}
