"""Word lists for the built-in scorer."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    """Lower-case words that count for each class.

    The words travel inside the query plan as sets of literals.
    ``neutral_prior`` is the score NEU starts from: less than one hit, so that a text without any
    hit is NEU, and one hit decides.
    """

    negative: tuple[str, ...]
    neutral: tuple[str, ...]
    positive: tuple[str, ...]
    neutral_prior: float = 0.5

    def __post_init__(self):
        words = self.negative + self.neutral + self.positive
        if len(set(words)) != len(words):
            raise ValueError("a lexicon word may count for one class only, and be listed once")
        if any(not word or word != word.lower() or len(word.split()) != 1 for word in words):
            raise ValueError("lexicon words are lower-case and hold no blanks")


OPINION_WORDS = Lexicon(
    negative=tuple(
        "awful bad boring broke broken cheap cheaply complain crap damaged defective disappointed "
        "disappointing disappointment dislike dreadful fail failed fails fake faulty flimsy garbage "
        "hate hated horrible junk lousy misleading missing mistake nasty overpriced pathetic poor "
        "poorly problem problems refund regret return returned ridiculous rubbish ruined scam shame "
        "sucks terrible ugly unacceptable unfortunately unhappy unreliable unusable upset useless "
        "waste wasted worse worst worthless wrong".split()
    ),
    neutral=tuple(
        "acceptable adequate average decent expected fair fine mediocre middling moderate normal "
        "ok okay ordinary passable reasonable standard so-so typical usual".split()
    ),
    positive=tuple(
        "amazing awesome beautiful beautifully best better brilliant comfortable cool cute delicious "
        "delighted easy enjoy enjoyed excellent exceeded fabulous fantastic fast favorite flawless fun "
        "generous glad good gorgeous great happy helpful impressed impressive incredible love loved "
        "lovely loves nice outstanding perfect perfectly pleasant pleased quality recommend recommended "
        "reliable satisfied sturdy super superb terrific thrilled useful well wonderful worth wow".split()
    ),
)
