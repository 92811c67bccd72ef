"""Rule pack, stance patterns and source catalogue for the open-internet docket.

Everything below is fixed data: the phrases, patterns and labels must be spelt exactly as they
occur in the filings and in the label scheme of existing annotated corpora.
"""

from __future__ import annotations

from .model import Rule, all_of, any_of, prefix

# --- fixed values: source rules in priority order -------------------------------------------
SOURCE_RULES: list[Rule] = [
    any_of("form.aclu", "proposal to reverse net neutrality protections because a free and open internet is vital for our democracy"),
    any_of(
        "form.att",
        "I am writing in regard to the Commission’s work on preserving an open internet",
        "there is a right way and a wrong way to preserve the concept of an open internet",
        "While the internet has drastically changed over the years, our internet regulations remain outdated",
        "the open internet is compromised when partisan politics and regulatory uncertainty come into play",
        "overturn the existing burdensome rules at the FCC and enact lasting legislation",
        "time for Congress to provide clear direction by passing legislation that provides certainty",
        "overturn the current law designed 80 years ago, before the Internet was created, is a great first step",
        "our internet regulations remain outdated",
        "heavy-handed regulations will do more harm than good",
        "get rid of the rules that were harming the internet economy",
        "urge you to work with your fellow members of Congress and the FCC to permanently preserve an open internet by supporting bipartisan legislation",
        "believe only legislation can ensure we have permanent, enforceable open internet rules",
        "Bipartisan legislation can help end the years-long political back-and-forth",
        "get rid of the rules that unfairly and heavy-handedly enforced these principles",
    ),
    any_of("bot.telephone_monopoly", "Title II is a Depression-era regulatory framework designed for a telephone monopoly that no longer exists"),
    any_of("bot.titleii_takeover", "enable the federal government to exert an extraordinary and unnecessary amount of regulatory control"),
    prefix("bot.unprecedented", "The unprecedented regulatory power the Obama Administration imposed on the internet"),
    prefix("bot.outraged", "I was outraged by the Obama/Wheeler FCC"),
    any_of("form.battleforthenet", "Open Internet Rules (net neutrality rules) are extremely important to me"),
    any_of("reddit.technology", "my understanding that the FCC Chairman intends to reverse net neutrality rules"),
    any_of("blog.venturebeat", "i support the existing net neutrality rules, which classify internet service providers under the title i", ignore_case=True),
    prefix("form.diminished-investment", "Obama’s Title II order has diminished broadband investment"),
    any_of("form.freeourinternet", "passed rules treating the internet as a government regulated public utility for the first time in history", ignore_case=True),
    prefix("form.freeourinternet", "In 2015, wealthy leftist billionaires and powerful Silicon Valley monopolies took the internet"),
    prefix("form.freeourinternet", "Rapacious Silicon Valley monopolies like Amazon"),
    any_of("form.fwact", "Dear Express Restoring Internet Freedom,"),
    prefix("form.tpa", "Obama's Federal Communications Commission (FCC) forced regulations on the internet that put the government"),
    any_of("form.tpa", "These rules have cost taxpayers, slowed down broadband infrastructure investment, and hindered competition and choice for Americans"),
    any_of("bot.internetuser", "The FCC should throw out Chairman Ajit Pai's proposal to give the ISP monopolies"),
    any_of("form.dearfcc", "The FCC needs to stand up for Internet users like me and keep the net neutrality rules that are already in effect."),
    any_of("form.dearfcc", "plan to give the government-subsidized ISP monopolies like AT&T, Verizon, and Comcast the legal cover to throttle"),
    prefix("bot.illogically-named", 'This illogically named "restoring internet freedom" filing is aimed squarely at the freedom of the internet'),
    prefix("form.signforgood", "Don't kill net neutrality. We deserve a free and open Internet"),
    prefix("form.freepress", "Net Neutrality is not negotiable"),
    prefix("form.freepress2", "Cable and phone companies provide access to the internet"),
    prefix("form.demandprogress", "A free and open internet is critical for Americans to connect with their friends and family, exercise their freedom of speech"),
    any_of("bot.best_cop", "Restore privacy by repealing Net Neutrality"),
    any_of("bot.telecommunications_act", "I am in favor of strong net neutrality under Title II of the Telecommunications Act"),
    any_of("bot.dissapear", "make sure net neutrality does not dissapear"),
    any_of("bot.thenewsearchengine", "small companies to compete with large online businesses up to the whims of our internet providers"),
    any_of("bot.economics_free_zone", "own chief economist Tim Brennan called the rules"),
    any_of("bot.corrupt_result", "corrupt result of a corrupt process"),
    any_of("bot.maga", "mesmorized by money that it jeopardizes the well-being of its citizens. Is this how we MAGA"),
    any_of("bot.rammed", "the Obama Administration rammed through a massive scheme that gave the federal government broad regulatory control over the internet"),
    all_of(
        "bot.wheeler",
        "imposed restrictive Title II, utility-style regulations under the guise of an",
        "By rolling back the misguided 2015 regulations we can restore an unrestricted and truly open internet",
    ),
    all_of(
        "bot.commonsense",
        "The current FCC regulatory scheme known",
        "The internet has flourished for decades without the heavy hand of government over-regulation",
        "plan to return to a commonsense regulatory framework",
    ),
    any_of("bot.day_of_action", "On July 12 is the Protect Net Neutrality Day of Action"),
    any_of("bot.serious", "Dear Ladies and Gentlemen. Net neutrality is a serious topic"),
    all_of("bot.mercy", "We need net neutralityto continue", "control should not be at the mercy of corporations"),
    any_of("bot.save_the_internet", "Please save the internet from the corporations. Tom Wheeler was right. Let the new neutrality stand"),
    all_of(
        "form.techcrunch",
        "Paragraph 82 asks for input on whether throttling should be regulated",
        "In the past ISPs have throttled content based on their own determination of what was lawful or permissible",
    ),
    any_of("bot.free_market_internet", "The free-market Internet was an incredible engine of economic growth"),
    any_of("form.protecting_taxpayers", "As a concerned taxpayer and consumer, I am writing to urge the FCC"),
    any_of("bot.freelance", "As a freelance translator I rely on internet"),
    all_of(
        "form.battleforthenet",
        "power to block websites",
        "slow them down",
        "split the internet into",
        "fast lanes",
        "for companies that pay",
        "slow lanes",
        "for the rest",
        ignore_case=True,
    ),
    all_of("form.techcrunch", "worried that the protections that are in place will be weakened if we change the way", ignore_case=True),
    all_of(
        "bot.unfair",
        "Allowing broadband providers to throttle their service is unfair business",
        "Weakening protections for consumers for the sake of big business is foolish",
        "This proposal clearly gets rid of net neutrality.",
        "I am opposed to this",
        "Save net neutrality and protect consumers",
        ignore_case=True,
    ),
    Rule(
        "form.dearfcc",
        (
            ("The FCC should reject Chairman Ajit Pai", "The FCC should throw out Chairman Ajit Pai"),
            ("stripping consumers", "stripping users", "stripping Internet users"),
            ("of the necessary", "of the meaningful", "of the vital"),
            ("Thankfully, the current", "Thankfully, the existing"),
            ("net neutrality rules", "FCC regulations", "Open Internet rules"),
            ("ensure that", "mean that"),
        ),
        ignore_case=True,
    ),
    all_of(
        "form.microbusiness",
        "proposed plan to repeal net neutrality protections would put a huge burden on microbusinesses like mine",
        "32% of creative entrepreneurs on the platform",
        "Chairman Pai is not only taking away our livelihood, he is also putting up barriers to entrepreneurs",
        ignore_case=True,
    ),
    all_of(
        "form.ofa",
        "Net neutrality guarantees a free and open internet",
        "Without it, internet service providers could block or censor websites, or create",
        "ISPs can't be allowed to abuse their position, potentially hurting businesses and consumers across the country, and privileging their own content over competitors",
        "Revoking net neutrality by changing the Title II classification of internet access would be bad for people, bad for competition and entrepreneurship, and it's bad for the internet",
        "I fully support keeping the current Title II classification of internet access and keeping the internet free and open",
        ignore_case=True,
    ),
    any_of(
        "bot.recursive",
        "It (undid|broke|disrupted|stopped|reversed|ended) a (market-based|pro-consumer|free-market|hands-off|light-touch) (policy|approach|system|framework) that (performed|functioned|worked) (fabulously|exceptionally|very, very|very|supremely|remarkably) (smoothly|successfully|well) for (many years|a long time|two decades|decades) with (Republican and Democrat|bipartisan|both parties'|nearly universal|broad bipartisan) (consensus|approval|backing|support)",
        mode="regex_anchored",
        target="last_sentence",
        needs=("It ",),
    ),
    any_of(
        "johnoliver",
        "(strong )?net neutrality( rules)? backed by title (ii|2|two|ll)",
        "i( specifically| strongly)? support( strong)? net neutrality backed by title",
        "i( specifically| strongly)? support( strong)? net neutrality,?( oversight)?( backed)? by title (ii|2|two|ll) oversight",
        mode="regex_search",
        ignore_case=True,
        needs=("net neutrality",),
    ),
]

# --- fixed values: stance patterns, searched without regard to case ---------------------------
SUPPORT_PATTERNS = [
    "(preserve|keep|maintain|uphold|continue|protect)( net)? neutral(ity)?",
    "(preserve|keep|maintain|uphold|continue|protect) title (ii|2|two|ll)?",
    "I( strongly)? support title (2|ii|two|ll)",
    "I( strongly| specifically)? support( strong)? net neutrality",
    "(strongly|specifically) support (net neutrality|title (ii|2|two|ll))",
    "do not (repeal|revoke|remove)",
]
OPPOSE_PATTERNS = [
    "obama'?s internet takeover",
    "please reverse the (2014|2015)",
    "please roll ?back",
]

# Literals without which none of the patterns above can match.
SUPPORT_NEEDS = ["neutral", "title", "do not "]
OPPOSE_NEEDS = ["internet takeover", "please "]

# --- fixed values: source catalogue (label, icon, stance, url) --------------------------------
CATALOGUE: list[tuple[str, str, str, str | None]] = [
    ("bot.recursive", "bot", "negative", None),
    ("bot.unprecedented", "form", "negative", "http://cfif.org/v/index.php/commentary/62-technology-and-telecom/3596-center-for-individual-freedom-mobilizes-americans-opposed-to-the-obama-administrations-title-ii-internet-power-grab-"),
    ("bot.outraged", "bot", "negative", None),
    ("form.diminished-investment", "form", "negative", "http://action.americancommitment.org/ctas/advocacy-251-repeal-obamas-internet-regulations/letter"),
    ("form.freeourinternet", "form", "negative", "http://freeourinternet.org/take-action/"),
    ("form.fwact", "form", "negative", "https://fwact.org/M0VU4IR"),
    ("form.tpa", "form", "negative", "http://www.tpaaction.org/"),
    ("bot.best_cop", "bot", "negative", None),
    ("bot.economics_free_zone", "bot", "negative", None),
    ("bot.corrupt_result", "bot", "negative", None),
    ("form.att", "form", "negative", "http://about.att.com/sites/open_internet"),
    ("bot.telephone_monopoly", "bot", "negative", None),
    ("bot.titleii_takeover", "bot", "negative", None),
    ("form.aclu", "form", "positive", "https://action.aclu.org/secure/comment-net-neutrality"),
    ("form.battleforthenet", "form", "positive", "https://www.battleforthenet.com/"),
    ("reddit.technology", "form", "positive", "https://www.reddit.com/r/technology/comments/6894i9/heres_how_to_contact_the_fcc_with_your_thoughts/?st=j5lzcn7t&sh=e7e2f698"),
    ("blog.venturebeat", "form", "positive", "https://venturebeat.com/2017/05/08/how-to-protest-the-fccs-plan-to-dismantle-net-neutrality/"),
    ("bot.internetuser", "form", "positive", "https://www.eff.org/deeplinks/2017/06/nlpcs-false-report-diverts-attention-concerns-real-net-neutrality-supporters"),
    ("form.dearfcc", "form", "positive", "https://dearfcc.org/"),
    ("bot.illogically-named", "bot", "positive", None),
    ("form.signforgood", "form", "positive", "https://petitions.signforgood.com/ProtectNetNeutrality/"),
    ("form.freepress", "form", "positive", "http://act.freepress.net/sign/internet_NN_pai/"),
    ("form.freepress2", "form", "positive", "http://act.freepress.net/letter/internet_fcc_nprm_nn_2017/"),
    ("form.demandprogress", "form", "positive", "https://act.demandprogress.org/sign/trump-pai-attack-net-neutrality/"),
    ("bot.dissapear", "bot", "positive", None),
    ("bot.telecommunications_act", "bot", "positive", None),
    ("bot.thenewsearchengine", "bot", "positive", None),
    ("bot.maga", "bot", "positive", None),
    ("johnoliver", "form", "positive", "https://www.youtube.com/watch?v=92vuuZt7wak"),
    ("bot.rammed", "bot", "negative", None),
    ("bot.wheeler", "bot", "negative", None),
    ("bot.commonsense", "bot", "negative", None),
    ("bot.day_of_action", "bot", "positive", None),
    ("bot.serious", "bot", "positive", None),
    ("bot.mercy", "bot", "positive", None),
    ("bot.save_the_internet", "bot", "positive", None),
    ("form.techcrunch", "form", "positive", "https://techcrunch.com/2017/04/27/how-to-comment-on-the-fccs-proposal-to-revoke-net-neutrality/"),
    ("bot.free_market_internet", "bot", "negative", None),
    ("form.protecting_taxpayers", "form", "negative", "https://www.protectingtaxpayers.org/take-action/"),
    ("bot.freelance", "bot", "positive", None),
    ("bot.unfair", "bot", "positive", None),
    ("form.microbusiness", "form", "positive", "http://www.carvedwoodenspoons.com/blog/protect-net-neutrality"),
    ("form.ofa", "form", "positive", "https://www.ofa.us/protect-net-neutrality/"),
]

# --- fixed values: labels written by the phrase tagger ----------------------------------------
PHRASE_LABELS = {"positive": "es_terms_positive", "negative": "es_terms_negative"}

# --- fixed values: catalogue labels the older stance lists leave out --------------------------
UNLISTED = ["bot.unfair", "form.microbusiness", "form.ofa", "johnoliver", "bot.commonsense"]

# --- fixed values: phrases that mark a position, matched with slop 3 ---------------------------
OPPOSE_PHRASES = [
    "our internet regulations remain outdated",
    "strongly support fully repealing",
    "Repeal the Obama Wheeler Internet regulations",
    "Save American jobs by repealing Net Neutrality",
]
SUPPORT_PHRASES = [
    "afraid of pay-to-play",
    "backed by title 2 oversight of ISP",
    "Changing Title II requirements would adversely",
    "do not change title 2",
    "essential net neutrality",
    "fast lane",
    "FCC should reject Chairman Ajit Pai's plan",
    "FCC should throw out Chairman Ajit Pai's plan",
    "I believe in strong Net Neutrality",
    "internet is NOT a communication company GOLDEN EGG LAYING GOOSE",
    "Internet service providers should treat all data that travels over their networks fairly",
    "ISP should be regulated",
    "ISP should be monitored",
    "ISP should be under Title II",
    "ISP create fast lanes",
    "ISP need to be regulated",
    "keep net neutral",
    "keep net neutrality",
    "let the new neutrality stand",
    "maintain internet utility backed by Title 2",
    "maintain net neutrality",
    "maintain the protections of Title II",
    "maintaining net neutrality",
    "misleadingly named proceeding",
    "must remain regulated under Title II",
    "need net neutrality",
    "net neutrality important",
    "Net neutrality is essential",
    "Net neutrality is vital",
    "net neutrality protections",
    "net neutrality should be maintained",
    "preserve net neutrality",
    "preserve title 2",
    "proposal to modify the Net Neutrality rules is unwanted",
    "protect net neutrality",
    "remain as part of Title 2",
    "remain classified under Title II",
    "retain title 2",
    "retain title ii",
    "safeguard net neutrality",
    "save net neutrality",
    "should not be controlled by companies who can and will force information",
    "slow lane",
    "stand up for net neutrality",
    "strongly oppose Chairman Pai's proposal",
    "support backed by Title 2",
    "support classifying internet under Title II",
    "support net neutrality",
    "support title 2",
    "support title II",
    "treat all data on the internet the same",
    "upholding net neutrality protections",
]

# --- fixed values: relevance query of the ranking job -----------------------------------------
RANKING_CLAUSES = [
    "action cannot current despise escape isps job keep place protect stand tell trusted users",
    "keep stand tell net neutrality",
]
RANKING_PHRASE = "net neutrality"

# --- fixed values: English stop words -----------------------------------------------------------
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their "
    "then there these they this to was will with"
).split()
# Words that say nothing about a position in this docket, for the neighbour vote.
NEIGHBOUR_STOP_WORDS = [w for w in STOP_WORDS if w != "not"]
