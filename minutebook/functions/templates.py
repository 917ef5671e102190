"""Request templates for the language-model stages.

Fixed values: the instruction texts, models and temperatures the archive
tools send.  ``{date}`` and ``{text}`` are filled per row.
"""

# ---------------------------------------------------------------- fixed values
STRUCTURED_SUMMARY = (
    "You are a professional historian and archivist specializing in Oklahoma City Board of Education meetings. "
    "This is a meeting from {date}. "
    "Using only the content provided below, generate a structured summary with the following sections:\n\n"
    "1. **Synopsis:** An overview (3-7 sentences) of meeting's main theme, issues, context.\n"
    "2. **Summary:** A detailed summary of discussions, decisions, actions taken, motions, legal and financial "
    "statements and reports, controversies, and notable processes.\n"
    "3. **Key Notes:** List specific motions, resolutions, votes, personnel actions, financial matters, and "
    "significant issues discussed.\n\n"
    "Important guidelines:\n"
    "- Use only information present in the text\n"
    "- Include specific names, amounts, and dates when mentioned\n"
    "- Note any votes and their outcomes\n"
    "- Highlight personnel changes, appointments, or resignations\n"
    "- Mention significant financial decisions or budget items\n"
    "- If text is unclear or incomplete, note this limitation\n\n"
    "Meeting Minutes Text:\n{text}"
)
SHORT_SUMMARY = (
    "Summarize this Oklahoma City Board of Education meeting from {date}. "
    "Provide:\n"
    "1. **Synopsis:** Brief overview (1-2 sentences)\n"
    "2. **Summary:** Key discussions and decisions\n"
    "3. **Key Notes:** Important motions, votes, personnel changes, financial matters\n\n"
    "Meeting text:\n{text}"
)
CHUNK_SUMMARY = (
    "Provide a concise summary of the following transcript "
    "chunk so it can later be merged with other chunks.\n\n{text}"
)
MERGE_SUMMARY = (
    "You are an expert historian and analyst specializing in educational policy.\n"
    "Your task is to create a detailed yet concise summary of the following board of education meeting transcript.\n"
    "Capture the key decisions, debates, and discussions, emphasizing any policy changes, budget concerns, "
    "societal influences, or controversies mentioned in the meeting.\n"
    "Provide historical context where applicable, indicating how these discussions may reflect broader "
    "educational trends of the time.\n"
    "Structure the summary in a way that would be useful to researchers, historians, professors, and educators.\n\n"
    "{text}"
)
STRICT_SUMMARY = (
    "You are an impartial meeting scribe. Summarise the following board-of-education "
    "meeting transcript using concise paragraphs. Include ONLY information that is "
    "explicitly present in the transcript.Do NOT add background knowledge, opinions, "
    "interpretations or historical context beyond what is written. Emphasise key decisions, "
    "debates, motions, votes, budget discussions and controversies when they appear."
)
STRICT_OUTLINE = (
    "Create a chronological bullet‑point outline of the meeting. Use ONLY facts explicitly "
    "found in the transcript. No external information or assumptions."
)
STRICT_DECISIONS = (
    "Identify every motion, resolution or vote that is explicitly recorded in the transcript. "
    "Return them as a JSON array, each item formatted: {\"motion\": str, \"result\": str, "
    "\"yes\": int|null, \"no\": int|null}. If the transcript contains none, return an empty array []."
)
FUSE = (
    "Merge the following partial summaries into a single coherent summary, ensuring you keep "
    "ONLY the information that appears explicitly in the partials, with no additional detail."
)

# stage -> (template or system prompt, model, temperature, prompt is system message)
STAGES = {
    "structured_summary": (STRUCTURED_SUMMARY, "gpt-3.5-turbo-16k", 0.2, False),
    "short_summary": (SHORT_SUMMARY, "gpt-3.5-turbo", 0.2, False),
    "chunk_summary": (CHUNK_SUMMARY, "gpt-4", 0.3, False),
    "merge_summary": (MERGE_SUMMARY, "gpt-4", 0.2, False),
    "summary": (STRICT_SUMMARY, "gpt-4o-mini", 0.0, True),
    "outline": (STRICT_OUTLINE, "gpt-4o-mini", 0.0, True),
    "decisions": (STRICT_DECISIONS, "gpt-4o-mini", 0.0, True),
    "fuse": (FUSE, "gpt-4o-mini", 0.0, True),
}
CONTEXT_ERRORS = ("context_length_exceeded", "maximum context length")
# ------------------------------------------------------------ end fixed values
