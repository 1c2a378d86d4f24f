"""Token-space constants and name lists shared by all operators."""

# --- fixed values: special token ids -----------------------------------------
BASE_VOCAB_SIZE = 128256
END_OF_TEXT = 128009
START_OF_SPEECH = 128257
END_OF_SPEECH = 128258
START_OF_HUMAN = 128259
END_OF_HUMAN = 128260
START_OF_AI = 128261
END_OF_AI = 128262
PAD = 128263
AUDIO_BASE = 128266
IGNORE_LABEL = -100

# --- fixed values: codec geometry --------------------------------------------
SLOTS = 7
CODEBOOK = 4096
MAX_AUDIO_TOKEN = AUDIO_BASE + (SLOTS - 1) * CODEBOOK + CODEBOOK - 1
CUSTOM_TOKEN_SHIFT = 10
CUSTOM_TOKEN_COUNT = SLOTS * CODEBOOK + CUSTOM_TOKEN_SHIFT + 1
SAMPLE_RATE = 24000
FRAME_SAMPLES = 2048
WINDOW_FRAMES = 4

# --- fixed values: limits and defaults ---------------------------------------
MAX_LEN_A = 8192
MAX_LEN_B = 4096
MIN_DURATION_S = 0.5
MAX_DURATION_S = 20.0
ROWS_PER_SHARD = 512
SHARDS_PER_TASK = 64
DEFAULT_SPEAKER = "speaker"
DEFAULT_VOICE = "Metin"
DEFAULT_GRANULARITY = "sentence"
DEFAULT_RESPONSE_FORMAT = "pcm"
DEFAULT_REPETITION_PENALTY = 1.1
DEFAULT_MAX_TOKENS = 2000
DEFAULT_TEMPERATURE = 0.4
DEFAULT_TOP_P = 0.5

# --- fixed values: voices, emotive tags, style words -------------------------
VOICES = ["zoe", "zac", "jess", "leo", "mia", "julia", "leah"]
EMOTIVE_TAGS = ["laugh", "chuckle", "sigh", "cough", "sniffle", "groan", "yawn", "gasp"]
STYLE_WORDS = [
    "happy", "normal", "digust", "disgust", "longer", "sad", "frustrated", "slow", "excited", "whisper",
    "panicky", "curious", "surprise", "fast", "crying", "deep", "sleepy", "angry", "high", "shout",
]

# --- fixed values: IPA symbol to phoneme token -------------------------------
PHONEMES = {
    "dʒ": "<|ph_dj|>", "tʃ": "<|ph_ch|>",
    "æ": "<|ph_ae|>", "ø": "<|ph_oe|>", "œ": "<|ph_OE|>", "ɔ": "<|ph_O|>",
    "ɛ": "<|ph_E|>", "ɪ": "<|ph_I|>", "ɯ": "<|ph_ih|>", "ʊ": "<|ph_U|>",
    "ɟ": "<|ph_gj|>", "ɡ": "<|ph_g|>", "ɫ": "<|ph_L|>", "ɾ": "<|ph_R|>",
    "ʃ": "<|ph_sh|>", "ʒ": "<|ph_zh|>",
    "ˈ": "<|ph_stress|>", "ː": "<|ph_long|>",
    "a": "<|ph_a|>", "b": "<|ph_b|>", "c": "<|ph_c|>", "d": "<|ph_d|>", "e": "<|ph_e|>", "f": "<|ph_f|>",
    "h": "<|ph_h|>", "i": "<|ph_i|>", "j": "<|ph_j|>", "k": "<|ph_k|>", "l": "<|ph_l|>", "m": "<|ph_m|>",
    "n": "<|ph_n|>", "o": "<|ph_o|>", "p": "<|ph_p|>", "r": "<|ph_r|>", "s": "<|ph_s|>", "t": "<|ph_t|>",
    "u": "<|ph_u|>", "v": "<|ph_v|>", "y": "<|ph_y|>", "z": "<|ph_z|>",
    " ": "<|ph_sp|>",
}

# --- fixed values: sentence marks, closing characters, trimmed white space ---
SENTENCE_MARKS = ".!?…"
CLAUSE_MARKS = ".!?…,:;\n"
CLOSING_CHARS = "\"')]}”’ "
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0           "
    "     　"
)
