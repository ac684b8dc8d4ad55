"""Reading and writing: raw click text, sessionised clicks, IP ranges, metric rows."""
