"""Driver-side settings of the operators (parameters, not operators)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that results depend on.
# Label sentinel ignored by the loss, and reserved vocabulary ids.
IGNORE_INDEX = -100
PAD_ID = 0
EOS_ID = 1
BOS_ID = 2
UNK_ID = 3
FIRST_WORD_ID = 4
# Length defaults: preference max_length 512 / prompt 128 / target 128;
# seq2seq source 1024 / target 128; causal 1024 per side.
PREF_MAX_LENGTH = 512
PREF_MAX_PROMPT_LENGTH = 128
PREF_MAX_TARGET_LENGTH = 128
SEQ2SEQ_SOURCE_LENGTH = 1024
SEQ2SEQ_TARGET_LENGTH = 128
CAUSAL_MAX_LENGTH = 1024
# Rows per CSV shard and the shard holdout settings.
SHARD_ROWS = 666
HOLDOUT_FRACTION = 0.25
# Shards per folder: a folder is written by one task.
FOLDER_SHARDS = 150
DEFAULT_SEED = 42
TRAIN_FRACTION = 0.8
# Whitespace that separates words in the corpus vocabulary.
WORD_SPLIT_PATTERN = "[ \n\t\r]+"


@dataclass(frozen=True)
class TokenSpec:
    """Special token ids and padding side (pad may fall back to eos)."""

    pad: int | None = PAD_ID
    eos: int | None = EOS_ID
    bos: int = BOS_ID
    unk: int = UNK_ID
    padding_side: str = "right"
    ignore_pad_for_loss: bool = True

    def pad_or_eos(self) -> int:
        """Padding id for generated/label arrays: pad, else eos, else error."""
        if self.pad is not None:
            return self.pad
        if self.eos is not None:
            return self.eos
        raise ValueError("padding needs a pad or an eos id")

    def with_pad_as_eos(self) -> "TokenSpec":
        return TokenSpec(self.eos, self.eos, self.bos, self.unk,
                         self.padding_side, self.ignore_pad_for_loss)


@dataclass(frozen=True)
class SourceSpec:
    """Input checks made before any job starts."""

    dataset_dir: str | None = None
    train_file: str | None = None
    validation_file: str | None = None
    test_file: str | None = None
    max_target_length: int = SEQ2SEQ_TARGET_LENGTH
    val_max_target_length: int | None = None
    extensions: tuple = field(default=("csv", "json", "jsonl", "parquet"))

    def __post_init__(self):
        if not (self.dataset_dir or self.train_file or self.validation_file
                or self.test_file):
            raise ValueError("need a dataset folder or at least one file")
        for name in ("train_file", "validation_file"):
            path = getattr(self, name)
            if path is not None:
                ext = path.rsplit(".", 1)[-1].lower()
                if ext not in self.extensions:
                    raise ValueError(f"{name} must be one of {self.extensions}")
        if self.val_max_target_length is None:
            object.__setattr__(self, "val_max_target_length",
                               self.max_target_length)

    def splits(self) -> dict:
        out = {}
        for split, path in (("train", self.train_file),
                            ("validation", self.validation_file),
                            ("test", self.test_file)):
            if path is not None:
                out[split] = path
        return out
