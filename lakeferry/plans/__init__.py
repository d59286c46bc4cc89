"""What can be said to a remote server, and what stays local."""
