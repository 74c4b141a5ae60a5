"""Word lists that must match the reference's resources.

Stored as plain text in natural order. Larger lexical resources
(lemma exceptions, polarity lexicon, tag lexicon) are taken as input
tables; the small defaults below only make the operators usable out of
the box.
"""

# The public English stopword list (179 words) used by the
# reference's tokenizer library, in its published order.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your
yours yourself yourselves he him his himself she she's her hers herself it
it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after
above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't
didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't
ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Class names shown for label 0 and label 1.
CLASS_NAMES = ["Non Sarcastic", "Sarcastic"]

# Phrases that drop an extracted text node (case-sensitive),
# and the parent tags whose text nodes are kept.
BODY_BLOCKLIST = ["Sign Up", "HuffPost", "Huffington"]
BODY_ALLOWED_PARENTS = ["p", "em", "i", "b"]

# Number of leading characters dropped from a link before
# the second lookup attempt.
LINK_PREFIX_LEN = 30

# Characters the sequence tokenizer replaces by a space
# before splitting on single spaces (the apostrophe is not among them).
SEQUENCE_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# Sequence ids reserved below the vocabulary.
PAD_ID = 0
OOV_ID = 1
