"""Word lists and constants of the keyword scorers."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    positive: tuple
    negative: tuple
    question: tuple = ()
    negation: tuple = ()


# Fixed values. Every word is looked for as a substring of the lower-cased text.
KEYWORDS = Lexicon(
    positive=(
        "good", "great", "awesome", "excellent", "love", "like", "amazing", "fantastic",
    ),
    negative=(
        "bad", "terrible", "awful", "hate", "dislike", "horrible", "worst", "sucks",
    ),
)

# Fixed values.
RULES = Lexicon(
    positive=(
        "good", "great", "excellent", "awesome", "love", "like", "happy", "best",
        "amazing", "wonderful", "fantastic", "perfect", "brilliant", "outstanding",
        "superb", "appreciate", "thanks", "respect", "congratulations",
    ),
    negative=(
        "bad", "terrible", "awful", "hate", "dislike", "sad", "worst", "horrible",
        "disappointing", "frustrating", "annoying", "stupid", "useless", "fail",
        "failed", "wrong", "problem", "difficult", "hard", "struggle",
    ),
    question=("?", "how", "what", "why", "when", "where"),
    negation=(
        "not", "no", "never", "nothing", "nobody", "nowhere", "neither", "cannot",
        "can't", "don't", "won't", "shouldn't", "couldn't",
    ),
)

# Names stored in model_version.
KEYWORD_MODEL = "simple-keyword"
RULE_MODEL = "lexicon-v2"
CLASSIFIER_MODEL = "bert-sentiment-v1"
EMPTY_MODEL = "empty"
# The classifier trained by this library.
TFIDF_MODEL = "tfidf-logistic-v1"
FALLBACK_MODEL = "fallback"

# What stands for a comment without usable text, or a failed one.
UNKNOWN_SENTIMENT = "unknown"
UNKNOWN_CONFIDENCE = 0.0
UNKNOWN_POSITIVE = 0.33
UNKNOWN_NEGATIVE = 0.33
UNKNOWN_NEUTRAL = 0.34
