"""Word lists. All lists are fixed values and can be replaced by argument."""

# Spark's default English stop words (org.apache.spark.ml.feature.StopWordsRemover).
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
    we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
    who's why's would
    """.split()
)

# Words too frequent in scientific abstracts to discriminate (cleaning pipeline).
DOMAIN_STOPWORDS = tuple(
    """
    study paper research result results propose proposed
    use used using show shown also two three one
    can may based method model approach data analysis
    system new different provide present work find found
    article examine review investigate explore discuss
    """.split()
)

# Generic academic words that disqualify a discovered term.
GENERIC_STOPWORDS = tuple(
    """
    paper study research article result results
    method methods approach approaches model models
    based using used use also however proposed
    show shows shown provide provided provides
    data work analysis different new two three
    one first second third may can ability
    findings finding potential review literature framework
    system systems context contexts level levels
    tool tools type types tasks task ways way
    important specific significant general possible
    """.split()
)

# The category phrase and its fifteen known keywords.
CATEGORY = "Concepts of Generative AI in Education"
CATEGORY_KEYWORDS = (
    "Generative models",
    "Prompting",
    "Machine learning",
    "Multimodality",
    "Fine-tuning",
    "Training data",
    "Algorithmic bias",
    "Explainability",
    "Transparency",
    "Ethics",
    "Privacy",
    "Personalization",
    "Human-AI interaction",
    "AI literacy",
    "Co-creation",
)

# A small seed of irregular and regular plurals; pass a full lemma table for real corpora.
SEED_LEMMAS = {
    "analyses": "analysis",
    "children": "child",
    "classes": "class",
    "criteria": "criterion",
    "hypotheses": "hypothesis",
    "images": "image",
    "languages": "language",
    "men": "man",
    "models": "model",
    "networks": "network",
    "students": "student",
    "studies": "study",
    "teachers": "teacher",
    "teeth": "tooth",
    "universities": "university",
    "women": "woman",
}
