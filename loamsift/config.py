"""Parameters of every step, as frozen dataclasses read on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """One text source: where it lies, which column is the text, how much to take."""

    domain: str
    dataset: str
    subset: str | None
    split: str
    text_column: str
    weight: float
    max_documents: int
    path: str | None = None
    format: str = "json"


# The declared source catalogue.
SOURCE_CATALOG: tuple[SourceSpec, ...] = (
    SourceSpec("web", "c4", "en", "train", "text", 0.40, 400),
    SourceSpec("books", "bookcorpus", None, "train", "text", 0.25, 100),
    SourceSpec("code", "bigcode/the-stack-dedup", "data", "train", "content", 0.15, 100),
    SourceSpec("news", "cc_news", None, "train", "text", 0.15, 100),
    SourceSpec("academic", "scientific_papers", "arxiv", "train", "abstract", 0.05, 50),
)


@dataclass(frozen=True)
class IngestConfig:
    seed: int = 42
    prefix_factor: int = 3
    min_words: int = 10
    max_words: int = 10_000


@dataclass(frozen=True)
class DedupConfig:
    """Documents are near duplicates if the Jaccard index of their word n-gram sets is high enough.
    ``keep`` says which document of a group stays: the ``first`` or the ``last``."""

    exact: bool = True
    fuzzy: bool = True
    hash_type: str = "md5"
    shingle_words: int = 3
    jaccard_threshold: float = 0.6
    keep: str = "first"


@dataclass(frozen=True)
class QualityConfig:
    perplexity_threshold: float = 5000.0
    high_share: float = 0.3
    medium_share: float = 0.7
    min_words: int = 50
    max_words: int = 100_000
    min_word_length: float = 3.0
    max_word_length: float = 10.0
    max_symbol_ratio: float = 0.25
    max_digit_ratio: float = 0.15
    max_url_ratio: float = 0.20
    max_duplicate_line_ratio: float = 0.30
    code_min_comment_ratio: float = 0.001
    code_max_comment_ratio: float = 0.85
    code_min_lines: int = 5
    code_max_lines: int = 20_000


@dataclass(frozen=True)
class SelectionConfig:
    rate: float = 0.95
    target_class: str = "high"
    min_target_docs: int = 5
    full_target_docs: int = 10
    max_features: int = 10_000
    min_df: int = 2
    max_df: float = 0.95
    importance_weight: float = 0.6
    attribute_weight: float = 0.4
    # Weights by quality class and by domain, and the weight of any other.
    quality_weights: dict = field(default_factory=lambda: {"high": 1.0, "medium": 0.7, "low": 0.3})
    domain_weights: dict = field(
        default_factory=lambda: {"web": 1.0, "books": 0.8, "code": 0.6, "news": 0.5, "academic": 0.4}
    )
    other_weight: float = 0.5


@dataclass(frozen=True)
class SamplingConfig:
    method: str = "unimax"
    alpha: float = 1.3
    max_epochs: int = 1
    seed: int = 42
    code_share_for_alpha: float = 0.3
    absent_preference: float = 0.1
    # Weights by quality class when sampling by attribute.
    quality_weights: dict = field(default_factory=lambda: {"high": 2.0, "medium": 1.0, "low": 0.5})
    other_quality_weight: float = 1.0


@dataclass(frozen=True)
class SequenceConfig:
    max_length: int = 2048
    batch_size: int = 8
    train_share: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class CorpusConfig:
    sources: tuple[SourceSpec, ...] = SOURCE_CATALOG
    ingest: IngestConfig = IngestConfig()
    dedup: DedupConfig = DedupConfig()
    quality: QualityConfig = QualityConfig()
    selection: SelectionConfig = SelectionConfig()
    sampling: SamplingConfig = SamplingConfig()
    sequences: SequenceConfig = SequenceConfig()
