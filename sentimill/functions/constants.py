"""Word lists and patterns."""

from __future__ import annotations

# English function words removed from summaries and review texts (fixed values).
STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should",
    "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven",
    "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't",
    "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
)

# Words about the shop rather than the product, left out of the topic words (fixed values).
SHOP_WORDS: tuple[str, ...] = (
    "amazon", "wanted", "product", "mouth", "today", "sent", "got", "don", "company", "producer",
    "item", "ordered", "dop", "received", "costco", "bag", "bought", "know", "thought", "facts",
    "february", "times", "going", "buy", "food", "way", "following", "apparently", "products", "caused",
    "noticed", "reviews", "previously", "uses", "cause", "wish", "ok", "okay", "forums", "want",
    "literally", "giving",
)

# Short forms and what they stand for; replace or extend through the ``contractions`` parameter.
CONTRACTIONS: dict[str, str] = {
    "ain't": "am not",
    "aren't": "are not",
    "can't": "cannot",
    "could've": "could have",
    "couldn't": "could not",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'll": "he will",
    "he's": "he is",
    "here's": "here is",
    "how's": "how is",
    "i'd": "i would",
    "i'll": "i will",
    "i'm": "i am",
    "i've": "i have",
    "isn't": "is not",
    "it'd": "it would",
    "it'll": "it will",
    "it's": "it is",
    "let's": "let us",
    "might've": "might have",
    "must've": "must have",
    "mustn't": "must not",
    "needn't": "need not",
    "she'd": "she would",
    "she'll": "she will",
    "she's": "she is",
    "should've": "should have",
    "shouldn't": "should not",
    "that'd": "that would",
    "that's": "that is",
    "there's": "there is",
    "they'd": "they would",
    "they'll": "they will",
    "they're": "they are",
    "they've": "they have",
    "wasn't": "was not",
    "we'd": "we would",
    "we'll": "we will",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what's": "what is",
    "where's": "where is",
    "who's": "who is",
    "won't": "will not",
    "would've": "would have",
    "wouldn't": "would not",
    "you'd": "you would",
    "you'll": "you will",
    "you're": "you are",
    "you've": "you have",
}

# Patterns (fixed values).  They use only syntax that means the same in Java and RE2.
TOKEN = r"[\p{L}\p{N}]+(?:'\p{L}+)?"
PLAIN_TOKEN = r"[\p{L}\p{N}]+"
PLAIN_TERM = r"[\p{L}\p{N}]{2,}"
NON_SPACE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD_RUN = NON_SPACE + "+"
VECTOR_TERM = r"[\p{L}\p{N}_]{2,}"
MARKUP_CHARS = "*`'\"+=."
EXTRA_CHARS = "’‘-"
VALID_SCORES: tuple[str, ...] = ("1", "2", "3", "4", "5")


def markup_pattern(extra_chars: str = "") -> str:
    """Tags, stray marks, links and the three markup words, also inside longer words."""
    return rf"<[^\n]*?>|[{MARKUP_CHARS}{extra_chars}]|http{NON_SPACE}+|href|span|class"
