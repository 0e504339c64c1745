"""The texts that the registered prompt queries pass as templates, written for the given tables."""

HELP_DESK = "Ticket text:\n{question}\n\nDraft the first reply of a help desk. Name each step the customer should take.\n"
RATE_TONE = "tone(positive | neutral | negative) of <<{input_string}>> ="
RATE_TONE_LIKE = "Rated messages\n{examples}\n\nMessage to rate\n{input_string}\nRating:"
SHOW_WORK = "{input_string}\n\nList what is given, then what follows from it, and end with one line that starts with 'Result:'.\n"
SURE_ONLY = "{input_string}\n\nIf this cannot be settled from the message alone, output the single word UNKNOWN.\n"
FROM_PASSAGES = "Passages\n--------\n{context}\n\nTask: {question}\nQuote the passage that settles the task, or output UNKNOWN.\n"
