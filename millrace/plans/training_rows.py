"""The operators put together, from texts to rows a trainer reads.

``ids``, ``attention_mask`` and ``labels`` have one length for all rows, except
where batches set their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.render import ChatTemplate, render_human_assistant, render_role_prefix
from millrace.functions.sequences import (
    IGNORED_LABEL,
    add_special,
    attention_mask,
    causal_labels,
    pad,
)
from millrace.operators.batches import assign_batches, epoch_order, pad_lists_to_batch_max
from millrace.operators.bpe import Vocabulary, train_bpe
from millrace.operators.candidates import (
    ban_repeat_bigrams,
    renormalize,
    sample,
    softmax,
    top_k,
    top_p,
)
from millrace.operators.conversations import preference_pairs, select_text
from millrace.operators.encode import encode, resolve_specials
from millrace.operators.preference import preference_tokens
from millrace.operators.words import corpus_words, word_counts
from millrace.session import cut_lineage
from millrace.sources.jsonl import limit_examples
from millrace.sources.vocabulary import Tokenizer


def train_tokenizer(df: DataFrame, vocab_size: int = 6400, min_frequency: int = 2) -> Vocabulary:
    """A vocabulary learned from the ``text`` column."""
    return train_bpe(word_counts(corpus_words(df, "text")), vocab_size, min_frequency)


def causal_rows(
    texts: DataFrame,
    key: str,
    vocabulary: Vocabulary | Tokenizer,
    pad_id: int,
    max_length: int = 512,
    bos_id: int | None = None,
) -> DataFrame:
    """``(key, input_ids, attention_mask, labels)`` from ``(key, text)``, with a start id in front if there is one."""
    room = max_length if bos_id is None else max_length - 1
    prefix_space = getattr(vocabulary, "prefix_space", True)
    head = encode(texts, key, "text", vocabulary.vocab, vocabulary.merges, room, prefix_space)
    head = head.select(F.col("key").alias(key), add_special(F.col("ids"), bos_id, None).alias("ids"))
    padded = pad(F.col("ids"), max_length, pad_id)
    return head.select(
        key,
        padded.alias("input_ids"),
        attention_mask(F.col("ids"), max_length).alias("attention_mask"),
        causal_labels(padded, pad_id).alias("labels"),
    )


def pretrain_rows(
    df: DataFrame, key: str, vocabulary: Vocabulary | Tokenizer, pad_id: int, max_length: int = 512
) -> DataFrame:
    """Rows for pretraining; the table must have a ``text`` column."""
    return causal_rows(select_text(df, key, only="text"), key, vocabulary, pad_id, max_length)


def fine_tuning_rows(
    df: DataFrame,
    key: str,
    vocabulary: Vocabulary | Tokenizer,
    pad_id: int,
    max_length: int = 512,
    renderer: Callable[[Column], Column] = render_role_prefix,
) -> DataFrame:
    """Rows for supervised fine-tuning, from conversations or plain texts.

    Every token carries a label, the prompts' too.
    """
    return causal_rows(select_text(df, key, renderer), key, vocabulary, pad_id, max_length)


def adapter_rows(
    df: DataFrame, key: str, vocabulary: Vocabulary | Tokenizer, pad_id: int, max_length: int = 512
) -> DataFrame:
    """Rows for adapter training: like fine-tuning, with ``Human:`` and ``Assistant:``."""
    return fine_tuning_rows(df, key, vocabulary, pad_id, max_length, render_human_assistant)


def preference_rows(
    df: DataFrame,
    key: str,
    vocabulary: Vocabulary | Tokenizer,
    template: ChatTemplate,
    prompt_mode: str = "chosen",
    max_prompt_length: int = 256,
    max_length: int = 512,
) -> DataFrame:
    """Token rows of preference pairs.

    The texts of a row are encoded side by side, so the row needs no shuffle to come
    together again. A prompt that is the chosen text is encoded once.
    """
    pairs = preference_pairs(df, key, template, prompt_mode)
    texts = ["chosen", "rejected"] if prompt_mode == "chosen" else ["prompt", "chosen", "rejected"]
    prefix_space = getattr(vocabulary, "prefix_space", True)
    encoded = encode(pairs, key, texts, vocabulary.vocab, vocabulary.merges, prefix_space=prefix_space)
    encoded = encoded.withColumnRenamed("key", key)
    if prompt_mode == "chosen":
        encoded = encoded.withColumn("prompt", F.col("chosen"))
    return preference_tokens(encoded, key, max_prompt_length, max_length)


def special_ids(roles: DataFrame, vocab: DataFrame) -> dict[str, int]:
    """The ids of ``bos``, ``eos``, ``pad`` and ``unk`` of a settings row, with their fallbacks.

    Roles without a token, or with one that the vocabulary lacks, are left out. At most
    four rows are collected.
    """
    names = ("bos", "eos", "pad", "unk")
    settled = resolve_specials(roles.select(*names).limit(1))
    pairs = F.array(*[F.struct(F.lit(name).alias("role"), F.col(name).alias("token")) for name in names])
    found = settled.select(F.inline(pairs)).join(vocab.select("id", "token"), "token")
    return {row.role: row.id for row in found.collect()}


def pretrain_batches(
    examples: DataFrame,
    key: str,
    vocabulary: Vocabulary | Tokenizer,
    specials: Mapping[str, int],
    limit: int | None = None,
    max_length: int = 512,
    epochs: int = 1,
    seed: int = 42,
    batch: int = 2,
    accum: int = 16,
    world: int = 1,
) -> DataFrame:
    """From examples to what a trainer reads: the first ``limit`` by key, as rows with a start
    id, padded and labelled, laid out over epochs, ranks and steps.

    The encoded rows are written once, in the checkpoint folder, before they are laid out.
    """
    chosen = limit_examples(examples, limit, [key], "clamp")
    texts = select_text(chosen, key, only="text")
    rows = causal_rows(texts, key, vocabulary, specials["pad"], max_length, specials.get("bos"))
    return batched_rows(cut_lineage(rows), key, epochs, seed, batch, accum, world)


def batched_rows(
    rows: DataFrame, key: str, epochs: int, seed: int, batch: int, accum: int = 1, world: int = 1
) -> DataFrame:
    """``rows`` once per epoch, with their place in it: ``epoch, pos, rank, micro, step``.

    The rows are read once more for their keys, so write encoded rows first, as with
    ``materialize_stage``.
    """
    placed = assign_batches(epoch_order(rows, key, epochs, seed), batch, accum, world)
    return placed.withColumnRenamed("key", key).join(rows, key)


def preference_batches(batched: DataFrame, pad_id: int) -> DataFrame:
    """Preference rows of a batch padded to its longest, each side by itself."""
    sides = ("chosen", "rejected")
    fills = {f"{side}_ids": pad_id for side in sides}
    fills |= {f"{side}_labels": IGNORED_LABEL for side in sides}
    masks = {f"{side}_ids": f"{side}_mask" for side in sides}
    return pad_lists_to_batch_max(batched, ["epoch", "rank", "micro"], fills, masks)


def next_tokens(
    scores: DataFrame,
    contexts: DataFrame,
    seed: int,
    temperature: float = 0.7,
    k: int = 50,
    p: float = 0.95,
) -> DataFrame:
    """``(context_id, token_id)``: one drawn token per context, no bigram repeated.

    A context without candidates, or with none that is allowed, has a null token.
    """
    allowed = ban_repeat_bigrams(scores, contexts)
    likely = top_p(renormalize(top_k(softmax(allowed, temperature), k)), p)
    drawn = sample(renormalize(likely), seed)
    return contexts.select("context_id").join(drawn, "context_id", "left")
