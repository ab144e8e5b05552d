import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def library_tokenizer(texts, vocab_size, min_frequency=2):
    """The same training with the public tokenizers package."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.BPE())
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    tokenizer.decoder = decoders.ByteLevel()
    tokenizer.train_from_iterator(
        texts,
        trainers.BpeTrainer(
            vocab_size=vocab_size,
            min_frequency=min_frequency,
            special_tokens=["<s>", "</s>", "<pad>", "<unk>"],
            show_progress=False,
        ),
    )
    return tokenizer


def library_merges(tokenizer):
    import json

    merges = json.loads(tokenizer.to_str())["model"]["merges"]
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
