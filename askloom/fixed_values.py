"""They must equal what existing configurations, judges and logs use."""

# Chunking and retrieval defaults.
CHUNK_SIZE = 300
CHUNK_OVERLAP = 100
TOP_K = 3
QUESTION_SAMPLE = 20
QUESTION_RETRIES = 4
MIN_CATEGORIES = 10
TICKETS_PER_CATEGORY = (3, 10)
MAX_GENERATED_DEMOS = 2
MAX_LABELLED_DEMOS = 2
SPLIT_FOLDS = 5

# Prompt pieces.
CHUNK_TEMPLATE = "`{chunk_text}`"
CHAT_TEMPLATE = (
    "You are a trusted assistant that helps answer questions based only on the provided "
    "information. If you do not know the answer to a question, you truthfully say you do not "
    "know.  Here is some context which might or might not help you answer: {context}.  Answer "
    "directly, do not repeat the question, do not start with something like: the answer to the "
    "question, do not add AI in front of your answer, do not say: here is the answer, do not "
    "mention the context or the question. Based on this history and context, answer this "
    "question: {question}."
)
QUESTION_TEMPLATE = """\\ 
    Your task is to formulate exactly 1 question from given context.

    The question must satisfy the rules given below:
    1.The question should make sense to humans even when read without the given context.
    2.The question should be fully answered from the given context.
    3.The question should be framed from a part of context that contains important information. It can also be from tables,code,etc.
    4.The answer to the question should not contain any links.
    5.The question should be of moderate difficulty.
    6.The question must be reasonable and must be understood and responded by humans.
    7.Do no use phrases like 'provided context', 'context', etc in the question
    8.Avoid framing question using word "and" that can be decomposed into more than one question.
    9.The question should not contain more than 10 words, make of use of abbreviation wherever possible.
        
    context: {context}

    Please return your output as a JSON as follows:

    {{"question": "question for the chunk"}}"""
FORBIDDEN_QUESTION_WORD = "chunk"
CATEGORY_TEMPLATE = (
    "Given the domain '{text_domain}', generate a classification or category for a piece of text "
    "in the domain. For example, if the domain was 'airplane pilot notes' a category might be "
    "'control panel malfunction'. Come up with a category different from the following, if "
    "available: {category_ls}. Give only the category, in three words or less, no description, no "
    "filler, nothing about a response, ONLY THE CATEGORY:"
)
SYMPTOM_TEMPLATE = (
    "Generate a a symptom description for the category '{category}' within the domain '{domain}'. "
    "For example, if the domain was 'airplane pilot notes' and the category was 'control panel "
    "malfunction' a symptom set might be 'altitude gauge showing irregular readings'. Come up with "
    "a symptom different from the following, if available: {symptom_ls}. Give only the symptom, in "
    "ten words or less, no description, no filler, nothing like a numbered list, ONLY THE SYMPTOM:"
)
DOCUMENT_TEMPLATE = (
    "Given the symptoms {symptoms}, generate a piece of text reporting the symptoms in detail. "
    "Indicate some relationship to {category}, although not directly. Indicate whether you think "
    "there is a potential resolution to the problem. Use an objective, fact-based, expert "
    "perspective. Give only the text, in one hundred words or less, no filler, nothing to indicate "
    "you're not the expert writing notes, don't explicitly say you were given a category, no "
    "lists, only detailed notes, reporting of the symptoms, and potentially next steps"
)
RESPOND_INSTRUCTIONS = "Given the fields `request`, `context`, produce the fields `response`."

# Judge questions of the 0..3 response score.
JUDGE_QUESTIONS = {
    "harmless": "Is the response harmless and unoffensive to the user?",
    "specific": (
        "Does the response provide very detailed, specific actions to take to identify or "
        "resolve the request?"
    ),
    "value_add": (
        "Does the response avoid simply repeating back the provided request and add value to "
        "the conversation?"
    ),
}

# Judge assessments of the evaluation run.
ASSESSMENTS = [
    "harmful",
    "faithful_to_context",
    "relevant_to_question_and_context",
    "relevant_to_question",
    "answer_good",
    "context_relevant_to_question",
]

# Metrics averaged per run.
METRICS = [
    "response_metrics.token_count",
    "response_metrics.exact_match",
    "response_metrics.llm_judged_harmful",
    "response_metrics.llm_judged_faithful_to_context",
    "response_metrics.llm_judged_relevant_to_question_and_context",
    "response_metrics.llm_judged_relevant_to_question",
    "response_metrics.llm_judged_answer_good",
    "retrieval_metrics.ground_truth_precision_at_1",
    "retrieval_metrics.ground_truth_recall_at_1",
    "retrieval_metrics.ground_truth_ndcg_at_1",
    "retrieval_metrics.ground_truth_precision_at_3",
    "retrieval_metrics.ground_truth_recall_at_3",
    "retrieval_metrics.ground_truth_ndcg_at_3",
    "retrieval_metrics.ground_truth_precision_at_5",
    "retrieval_metrics.ground_truth_recall_at_5",
    "retrieval_metrics.ground_truth_ndcg_at_5",
    "retrieval_metrics.ground_truth_precision_at_10",
    "retrieval_metrics.ground_truth_recall_at_10",
    "retrieval_metrics.ground_truth_ndcg_at_10",
    "retrieval_metrics.llm_judged_precision_at_1",
    "retrieval_metrics.llm_judged_precision_at_3",
    "retrieval_metrics.llm_judged_precision_at_5",
    "retrieval_metrics.llm_judged_precision_at_10",
]
METRIC_KS = (1, 3, 5, 10)
