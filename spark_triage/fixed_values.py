"""Word lists, patterns, thresholds and prompt texts.

These must equal the published ones for results to agree, so they are stated as plain text in their
natural order. Everything here is only a default; each operator takes its own value as a parameter.
"""

# ---- fixed values: patterns (Python/Java syntax, matched case-insensitively where noted) ----------

# Redirecting a customer off-thread: direct-message wording or a short link. Case-insensitive.
SHORT_LINK_PATTERN = r"https?://t\.co/\S+"
DEFLECTION_PATTERNS = (
    r"\bdm\b.{0,40}\b(us|you|your)\b",
    r"\b(us|you|your).{0,40}\bdm\b",
    r"\bdirect message\b",
    r"\bprivate message\b",
    r"\bsend (us )?a (direct|private) message\b",
    r"\bshoot us a dm\b",
    r"\bfollow (&|and) dm\b",
    SHORT_LINK_PATTERN,
)

# Fraud and security wording that overrides every other decision. Case-insensitive.
FRAUD_PATTERNS = (
    r"\bscam(med|mer|ming)?\b",
    r"\bfraud(ulent)?\b",
    r"\bphish(ing)?\b",
    r"\bhack(ed|er|ing)?\b",
    r"\bstole (my|our)\b",
    r"\bstolen (my|our)\b",
    r"\bunauthori[sz]ed\b",
    r"\bpolice\b",
    r"\bpretending to be you\b",
    r"\bidentity theft\b",
    r"\bsuspicious\b.{0,30}\b(email|account|message|link)\b",
    r"\baccount is locked\b.{0,25}\b(isn'?t|wasn'?t|not)\b",
    r"\bcc details\b",
    r"\bcredit card details\b",
)

# "pay for" vocabulary, which overlaps with billing without being a billing dispute. Case-insensitive.
PAY_FOR_PATTERNS = (r"\bpay(?:ing|s)?\s+for\b", r"\bpaid\s+for\b")

# Agent signature left in a reply, such as ^LR. Case-sensitive.
SIGNATURE_PATTERN = r"\^[A-Z]{2,3}\b"

EMAIL_PLACEHOLDER = "<EMAIL>"
PHONE_PLACEHOLDER = "<PHONE>"
URL_PLACEHOLDER = "<URL>"

GREETINGS = ("Hi", "Hello", "Hey", "Dear")

# Capitalised brand and product words that are not person names; the brand's own handle is added to it.
NAME_ALLOWLIST = (
    "Amazon", "AmazonIndia", "AmazonPrime", "Prime", "Kindle", "Alexa", "Echo", "Fire",
    "Visa", "MRP", "AWB", "DM", "US", "UK",
)

# ---- fixed values: sizes and thresholds -----------------------------------------------------------

WORKING_ROWS = 9_000
HELDOUT_ROWS = 4_000
SPLIT_SEED = 42
REPLY_TEMPLATE_CAP = 5
MIN_REPLY_LENGTH = 40

DISCOVERY_SAMPLE = 1_500
DISCOVERY_SEED = 42
K_CANDIDATES = (5, 6, 7, 8, 9, 10)
KMEANS_STARTS = 10
KMEANS_MAX_ITER = 300
TERMS_PER_CLUSTER = 15
EXAMPLES_PER_CLUSTER = 8
MAX_TERMS = 5_000

PSEUDO_LABEL_ROWS = 700
PSEUDO_LABEL_SEED = 42
PILOT_ROWS = 20
PILOT_SEED = 7

TOP_K_SIMILARITY = 20
TOP_K_EXAMPLES = 3
MIN_INTENT_MATCHES = 3
NEAR_VERBATIM_THRESHOLD = 0.85
DRAFT_TRIAL_ROWS = 15
DRAFT_TRIAL_SEED = 13

CONFIDENCE_THRESHOLD = 0.90
SIMILARITY_THRESHOLD = 0.74
SIMILARITY_STUDY_ROWS = 200
SIMILARITY_STUDY_SEED = 99

STRATIFIED_ROWS = 160
STRATIFY_SEED = 21
HARD_PER_CATEGORY = 10
HARD_TOTAL = 40
HARD_SEED = 22
HIGH_SIMILARITY_STRESS = 0.9
LOW_SIMILARITY_POOL = 50

HUMAN_SAMPLE_ROWS = 45
HUMAN_SAMPLE_SEED = 33

HIGH_RISK_INTENTS = (
    "account_access",
    "billing_subscription_dispute",
    "refund_return_dispute",
    "marketplace_seller_trust",
)

JUDGE_DIMENSIONS = (
    "relevance",
    "groundedness",
    "tone_match",
    "no_hallucinated_specifics",
    "actionability",
)

# ---- fixed values: messages and prompt texts ({brand}, {company} are filled in by the caller) -------

QUERY_PREFIX = "Represent this sentence for searching relevant passages: "
HOLDING_MESSAGE = "We've flagged this for immediate review by our security team."
CANNED_REPLY = "Thanks for reaching out -- we're looking into this and will follow up shortly."

CLASSIFY_HEAD = (
    "You are an intent classifier for {brand} customer support tweets.\n"
    "Classify the customer's tweet into exactly one of these intents:\n"
)
CLASSIFY_TAIL = (
    "\nReturn the single best-fitting intent key and your confidence (0-1) "
    "that this is the correct intent. Watch for sarcasm: lexically "
    "positive wording does not always mean positive_feedback."
)
CLASSIFY_FORMAT = (
    'Respond with ONLY a single valid JSON object of the form '
    '{"intent": "<one of the intent keys above>", "confidence": <0-1 number>}. '
    "No other text, no markdown code fences, no explanation."
)
CLASSIFY_RETRY = (
    "\n\nYour previous response was not valid JSON. "
    "Respond with ONLY valid JSON, no other text, no explanation, no markdown."
)

DRAFT_INSTRUCTION = (
    "You are {brand}, {company}'s customer support account on Twitter. Draft a "
    "reply to the customer's tweet below, in {brand}'s voice, mirroring the "
    "resolution pattern shown in the similar past examples.\n\n"
    "Do NOT invent any account-specific facts not present in the current tweet -- "
    "no order numbers, ship dates, tracking numbers, refund amounts, or other "
    "specifics the customer didn't actually provide. If a past example mentions "
    "such details, use it only as a pattern for HOW to respond, not as a fact "
    "about this customer's situation.\n\n"
    "Never use any person's name in your draft -- not the customer's, not an "
    "agent's -- whether it comes from a retrieved example or you'd otherwise be "
    "tempted to invent one. Address the customer generically ('Hi,' or 'Hi "
    "there,' or no name at all).\n\n"
    "Paraphrase in your own words -- do not copy a retrieved reply verbatim "
    "even when the situation is very similar."
)
DRAFT_EXAMPLES_HEAD = "\nSimilar past examples (customer tweet -> {brand}'s reply):"
DRAFT_TWEET_HEAD = "\nNow draft a reply to this customer tweet:"
DRAFT_TAIL = "\nRespond with ONLY the reply text. No quotes, no explanation."

JUDGE_INSTRUCTION = (
    "You are a skeptical quality auditor reviewing a customer support reply. You did "
    "NOT write this reply and have no stake in it looking good -- your job is to find "
    "problems, not to be charitable.\n\n"
    "Score the AGENT REPLY below on five dimensions, each on a 1-5 scale "
    "(1 = fails badly, 5 = excellent), with a one-sentence rationale for each:\n"
    "- relevance: does the reply address what the customer actually asked, rather "
    "than a generic non-answer?\n"
    "- groundedness: does the reply avoid inventing account-specific facts (order "
    "numbers, ship dates, refund amounts, tracking numbers) not present in the "
    "customer's message?\n"
    "- tone_match: does it read like a real brand support reply -- warm but "
    "professional -- rather than generic filler or a form letter?\n"
    "- no_hallucinated_specifics: distinct from groundedness -- does it avoid "
    "fabricated claims even if they sound plausible (a specific policy, timeline, "
    "or promise that was never actually made)?\n"
    "- actionability: does it tell the customer what happens next, rather than just "
    "acknowledging the problem?"
)
JUDGE_FORMAT = (
    "Respond with ONLY a single valid JSON object of the form: "
    '{"relevance": {"score": <1-5 int>, "rationale": "<one sentence>"}, '
    '"groundedness": {"score": <1-5 int>, "rationale": "<one sentence>"}, '
    '"tone_match": {"score": <1-5 int>, "rationale": "<one sentence>"}, '
    '"no_hallucinated_specifics": {"score": <1-5 int>, "rationale": "<one sentence>"}, '
    '"actionability": {"score": <1-5 int>, "rationale": "<one sentence>"}}. '
    "No other text, no markdown code fences."
)
JUDGE_RETRY = (
    "\n\nYour previous response was not valid JSON matching the required "
    "shape. Respond with ONLY valid JSON, no other text, no explanation, no markdown."
)

# ---- fixed values: the intent taxonomy (intent, label, definition, examples) ------------------------

TAXONOMY = (
    ("delivery_shipping_issue", "Delivery/Shipping Issue",
     "Late, damaged, missing, or wrong item; or a tracking status "
     '("delivered") that doesn\'t match what the customer actually received.',
     ("An iron box bought from Amazon was a damaged item because of less "
      "precautions in packing. So Replaced but no pickup. #Disappointed",
      "Several parcels delayed lately despite choosing next day and being "
      "a prime customer. What's going on?",
      "Thanks for leaving my parcel outside in the rain - very clever!!!",
      "how you gonna give me a shipping estimate of next week when I pay for 1 day delivery")),
    ("refund_return_dispute", "Refund/Return & Dispute Resolution",
     "Refund requests, balance/money disputes, subscribe-and-save issues.",
     ("will I be getting my postage refunded?",
      "A order placed by mistakenly. I cancelled the order. My amazon pay "
      "balance showing 0. My balance was 1299. When the amount will show "
      "on my balance?",
      "very poor experience with subscribe and save. Order never delivered. "
      "Refund messed up. Very poor show.")),
    ("account_access", "Account & Access Issues",
     "Login lockout, password reset failure, checkout/exchange technical friction.",
     ("Hey you locked me out of my account after I bought something and "
      "now won't let me log back in, what gives?!?",
      "sorry let me say that again in english, I cannot log in into my "
      "account even after reseting the password multiple times",
      "not able to check out with exchange despite the product page saying so. Help")),
    ("billing_subscription_dispute", "Billing/Subscription Charge Dispute",
     "Unwanted Prime membership charges, trial charges, cancellation "
     "difficulty -- being charged the wrong amount or an unwanted charge. "
     "NOT about a paid-for service level (e.g. delivery speed) not being "
     "met -- that's delivery_shipping_issue even if payment is mentioned.",
     ("second time in as many months that Amazon has gone into my account "
      "and stolen money for a Prime membership I do not want.",
      "I activated the Amazon Trial prime and £ 1 was deducted from my Visa card !",
      "Hi my account is meant to be closed but im still getting emails "
      "about prime payment issues?")),
    ("digital_service_device_support", "Digital Service/Device Technical Support",
     "Echo, Kindle, Alexa, app bugs, cross-device sync issues.",
     ("Just as an aside, what the hell have done to the Kindle App?! "
      "It's bloody awful, give me back my carousel!!",
      "Since the most recent update my spot in my books will no longer "
      "sync between my devices. All settings are correct.",
      "Bought Minecraft from Amazon Store on previous device. Wiped & "
      "sold device, Xferred acct to new device, now I get this - help!")),
    ("marketplace_seller_trust", "Marketplace/Seller Trust",
     "Counterfeit products, fake/misleading listings.",
     ("#PehleKaroPuriTayyari #FakeListings available at 699 without any "
      "deal, Lightning deal at 799. Same product with different MRP.",
      "Why does sell fake Maybelline products and even after many "
      "complaints, refuse to remove it and suspend the seller?")),
    ("positive_feedback", "Positive Feedback / No Action Needed",
     "Genuine gratitude or praise, requiring no support action. Lexical "
     "positivity alone is not sufficient -- watch for sarcasm (see the "
     "delivery-issue example).",
     ("I love online shopping. Christmas shopping is done. Thanks !",
      "So my will be arriving before 31st of October Thanks guys for speedy shipping.")),
    ("general_complaint_other", "General Complaint / Other",
     "Venting or off-topic requests with no specific actionable resolution path.",
     ("Amazon's customer service is very nonsense its customer care "
      "service has become very nonsense, not helping people pockets are being stupid",
      "I got fed up with stubborn attitude. It seems Amazon team supports fraud.",
      "I'm almost positive and the have it out for me.")),
)
INTENTS = tuple(row[0] for row in TAXONOMY)
