"""One frozen options object passed to operators (replaces the YAML config and request defaults)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults.
DEFAULT_SONG_STRUCTURE = ("[Verse 1]", "[Chorus]", "[Verse 2]", "[Chorus]", "[Bridge]", "[Chorus]", "[Outro]")
VERSE_STRUCTURE = ("Verse 1",)
SEQ2SEQ_PREFIX = "write a lyric based on this text: "
FALLBACK_PROMPT = "The world is"
FALLBACK_LINE = "The world keeps turning on and on."
GUTENBERG_START = "*** START OF THE PROJECT GUTENBERG EBOOK"
GUTENBERG_END = "*** END OF THE PROJECT GUTENBERG EBOOK"


@dataclass(frozen=True)
class Options:
    min_words: int = 3
    max_words: int = 150
    song_structure: tuple[str, ...] = DEFAULT_SONG_STRUCTURE
    tokens_per_section: int = 75
    ideal_words_per_line: int = 5
    temperature: float = 0.7
    repetition_penalty: float = 1.25
    top_k: int = 50
    top_p: float = 0.95
    max_attempts: int = 3
    validation_set_size: float = 0.1
    batch_size: int = 4
    epochs: int = 3
    use_keyword_prompt: bool = True
    keyword: str = "world"
    use_random_prompt: bool = False
    seed: int = 42
    model_name: str = "gpt2-medium"
    learning_rate: float = 3e-5
    style: str = "decoder"  # "decoder" (GPT-2 like) or "seq2seq" (T5 like)
    max_seq2seq_tokens: int = 128
    strip_subtitle_cues: bool = False  # dead rule in the reference, opt-in here
    daily_quota: int = 5
    extra: dict = field(default_factory=dict)
