from podium.functions.messages import judge_messages, message, parse_messages
from podium.functions.numeric import is_number, try_number
from podium.functions.text import clean_text

__all__ = ["clean_text", "is_number", "judge_messages", "message", "parse_messages", "try_number"]
