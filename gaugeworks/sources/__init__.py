"""Reading and writing: flat exports, JSON lists, databases, page texts, packages of sheets."""
