"""Results are only right when these equal the agreed ones."""

# Keyword sentiment: any of these as a substring of the lower-cased text.
POSITIVE_WORDS = ["good", "great", "success", "win", "improve", "breakthrough", "growth", "benefit"]
NEGATIVE_WORDS = ["bad", "fail", "crisis", "war", "disaster", "decline", "loss", "risk"]

# Sales rows count only with one of these states.
VALID_STATUS = ["completed", "pending"]

# Retrieval defaults.
RELEVANCE_THRESHOLD = 1.2
TOP_K = 3
MAX_TOP_K = 10
CANDIDATE_K = 6
RERANK_K = 3

# Chunk sizes (size, overlap) in characters: directory index, uploaded file.
DIRECTORY_CHUNKS = (500, 50)
UPLOAD_CHUNKS = (800, 100)
CHUNK_SEPARATORS = ["\n\n", "\n", " ", ""]

# What models put around a rewritten or translated query.
REWRITE_PREFIXES = ["Rewritten question:", "Rewritten standalone query:", "AI:", "User:", "Human:"]
REWRITE_MIN_LENGTH = 8
TRANSLATION_PREFIXES = ["English:", "Translation:", "EN:"]

# A query holding one of these is Chinese.
CJK_PATTERN = "[\\u4e00-\\u9fff]"

# Answer texts when no model answered.
ANSWER_NOTHING_FOUND = "未在新闻库中找到与该问题相关的报道，请换一种问法或尝试英文关键词。"
ANSWER_MODEL_UNAVAILABLE = "（LLM 暂不可用，以下为检索到的相关新闻，可直接参考 sources 字段）"
ANSWER_RETRIEVAL_ONLY = "（纯检索模式：以下为检索到的相关新闻，可直接参考 sources 字段）"

# Speaker names in a rendered conversation.
SPEAKERS = {"user": "Human", "assistant": "AI", "system": "System"}

# Prompt templates.
NEWS_PROMPT = (
    "You are a helpful news assistant. Answer the question using ONLY the news "
    "context below.\n"
    "Start your answer with the direct facts from the context. "
    "If the context truly does not contain the answer, then say 'I don't know'.\n"
    "Do not make up information. When you use a news item, mention its title and "
    "source link.\n"
    "Answer in the same language as the question (e.g. if the question is in "
    "Chinese, answer in Chinese).\n\n"
    "News Context:\n{context}\n\n"
    "Question: {question}\n"
    "Answer:"
)
DOCUMENT_PROMPT = """
Answer the user's question strictly based on the provided context.
If the answer cannot be found in the context, reply exactly with 'I don't know'.
Do NOT invent or add any knowledge outside the given context.

Context:
{context}

Question: {question}
Answer:
"""
CHAT_PROMPT = """
Answer the user's question strictly based on the provided context and chat history.
If the answer cannot be found in the context, reply exactly with 'I don't know'.
Do NOT invent or add any knowledge outside the given context.

Chat History:
{chat_history}

Context:
{context}

Question: {question}
Answer:
"""
TRANSLATION_PROMPT = (
    "Translate the following Chinese question into English for a news search. "
    "Output ONLY the English translation, without quotes or any other text.\n\n"
    "Chinese: {question}\nEnglish:"
)
REWRITE_PROMPT = (
    "System: Convert follow‑up question into a self‑contained search query. "
    "Output ONLY the query text, nothing else.\n"
    "Human: Chat history:\n{chat_history}\n\nLatest question: {question}"
)
